"""Errors raised before or instead of a write."""


class InvalidRowsError(ValueError):
    """Some rows break a rule that the whole batch must satisfy."""


class NotFoundError(LookupError):
    """A named tender does not exist."""
