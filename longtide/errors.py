"""Typed refusals. Queries stay lazy; these are raised at plan-building or write boundaries only."""


class LongtideError(Exception):
    """Base of all errors raised by this library."""


class SchemaRefusal(LongtideError):
    """A published column is missing, or a key column does not exist."""


class ShrinkRefusal(LongtideError):
    """A write would shrink a stored table below its floor."""


class EmptyRefusal(LongtideError):
    """A write would publish no rows."""


class ReportRefusal(LongtideError):
    """More new rows than the caller declared a report of changed series for."""


class UnsupportedFilter(LongtideError):
    """A filter that this engine does not answer; it is refused, never ignored."""


class GrainRefusal(LongtideError):
    """A time join between undeclared, unknown or mixed grains."""


class NotFound(LongtideError):
    """A resolved series or table has no rows."""
