"""scorebook: tabular prediction pipelines (featurize, train, promote, score) that run wholly on Spark."""

__version__ = "0.1.0"
