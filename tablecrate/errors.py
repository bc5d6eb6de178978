"""The one exception type raised for bad configs, bad snapshots and failed checks."""


class CrateError(Exception):
    """A job cannot go on: the message says which object and why."""
