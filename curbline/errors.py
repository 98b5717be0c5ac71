class DataQualityError(Exception):
    """The data broke a rule that a retry cannot fix."""
