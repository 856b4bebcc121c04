"""Ready-made jobs: the spec runner, the golden pipelines and the insight metrics."""
