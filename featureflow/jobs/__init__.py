"""spark-submit entry points: ``python -m featureflow.jobs.<name> --help``."""
