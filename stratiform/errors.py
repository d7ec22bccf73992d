"""Exceptions raised while a plan is being built."""


class ConfigError(ValueError):
    """Control metadata or options cannot be turned into a plan."""


class RuleError(RuntimeError):
    """A SQL expression taken from metadata does not resolve against the frame."""


class DuplicateKeyError(ValueError):
    """The source of an upsert holds a key more than once."""
