"""DataFrame operators, each parameterised by column names."""
