"""Credit-risk data work on Spark: features, sampling, models, decisions, reasons and fairness."""
