"""Error types raised by the library (driver-side control flow only)."""


class StratumError(Exception):
    """Base class."""


class ConfigurationError(StratumError, ValueError):
    """Bad metadata: unknown load type, malformed rule parameter, missing entity."""


class ReadError(StratumError):
    """A source could not be scanned (unsupported format, bad path)."""


class ValidationError(StratumError):
    """A gate found a failing ERROR-severity rule."""


class StateError(StratumError):
    """Change-detection state could not be read or written."""
