"""DataFrame -> DataFrame jobs, estimator builders and model reports."""
