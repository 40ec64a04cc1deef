"""The one error class of the engine."""


class EngineError(Exception):
    """A statement, type, literal or file that the engine can't work with; the cause is chained."""
