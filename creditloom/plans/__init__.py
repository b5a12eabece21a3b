"""The loan preset: the operators bound to the columns of the loan tables."""
