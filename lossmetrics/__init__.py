"""lossmetrics: claim and loss analytics as Spark DataFrame operators."""
