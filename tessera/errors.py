"""Errors that the engine raises; all are PipelineError."""

from __future__ import annotations


class PipelineError(Exception):
    """Base of all errors that stop a step."""


# -- inputs and their columns -------------------------------------------------------------------


class MissingInputError(PipelineError):
    """A file or folder that a step reads isn't there, or is empty."""


class MissingColumnsError(PipelineError):
    def __init__(self, step: str, missing: list[str]):
        super().__init__(f"{step}: missing columns {missing}")
        self.missing = missing


class InvalidValueError(PipelineError):
    """A column holds values that can't be parsed; the message has a few samples."""

    def __init__(self, column: str, samples: list[str]):
        super().__init__(f"{column}: invalid values {samples}")
        self.samples = samples


class ConflictingRowsError(PipelineError):
    """Several rows say different things of one key."""


class RegistryUriMismatchError(PipelineError):
    """A company's address doesn't name its number."""


class PayloadError(PipelineError):
    """A JSON payload has another shape than its contract."""


class BatchSettingsError(PipelineError):
    """Batch size, start or count is below 1."""


class SharedFolderError(PipelineError):
    """Executors can't see where intermediate tables would go."""


# -- snapshots and outputs ----------------------------------------------------------------------


class SnapshotError(PipelineError):
    pass


class SnapshotExistsError(SnapshotError):
    pass


class SnapshotNotFoundError(SnapshotError):
    pass


class SnapshotFileMissingError(SnapshotError):
    pass


class SnapshotTimeError(SnapshotError):
    """A time without a zone."""


class PendingNotFoundError(SnapshotError):
    """Nothing was acquired that could be cleaned."""


class OutputError(PipelineError):
    """An output table or report is missing or doesn't fit its contract."""


class NotDeterministicError(PipelineError):
    """Two runs over equal inputs wrote different rows."""


class ResumeError(PipelineError):
    """A run that should have found nothing to do did something."""


class AuditError(PipelineError):
    pass


# -- scoring and shortlisting -------------------------------------------------------------------


class ProfileError(PipelineError):
    """A scoring catalogue that doesn't fit its contract."""


class ProfileNotFoundError(ProfileError):
    """No catalogue at a path, or no profile of a name in it."""


class LocationsNotFoundError(PipelineError):
    pass


# -- sources ------------------------------------------------------------------------------------


class LinkNotFoundError(PipelineError):
    pass


class AmbiguousLinkError(PipelineError):
    pass


class SourceKindError(PipelineError):
    """A company source is neither a file nor an API one."""


class MissingSettingError(PipelineError):
    """A setting that a command needs isn't given."""


class MissingProfileRowError(PipelineError):
    """A company has no profile."""


class HttpError(PipelineError):
    def __init__(self, status: int, detail: str):
        super().__init__(f"status {status}: {detail}")
        self.status = status


class AuthenticationError(HttpError):
    """401 or 403: no use in asking again."""


class RateLimitedError(HttpError):
    def __init__(self, retry_after: float):
        super().__init__(429, f"asked to wait {retry_after:g} s")
        self.retry_after = retry_after


class CircuitOpenError(PipelineError):
    """Too many failures in a row; nothing is asked for a while."""


# -- runs and their ledger ----------------------------------------------------------------------


class LedgerError(PipelineError):
    """A ledger has no finished run, or one can't be added to it."""


class RunExistsError(LedgerError):
    """A run was finished before."""


# -- settings and commands ----------------------------------------------------------------------


class ConfigError(PipelineError):
    pass


class NotAvailableError(PipelineError):
    """A command that exists as a placeholder only, or under another name."""
