"""Failures of an export and their exit codes."""

from __future__ import annotations


class NotReady(Exception):
    """The source has not reached the end of the partition."""


class FailedValidation(Exception):
    """The export ran, but its result is not acceptable."""


class JobFailed(Exception):
    """Execution failed, timed out or was cancelled."""


class SourceError(Exception):
    """The database refused a statement."""


#: Fixed values, first match first.
EXIT_CODES = [(NotReady, 20), (OSError, 41), (ValueError, 43), (SourceError, 45), (JobFailed, 47), (FailedValidation, 50)]


def exit_code(error: BaseException) -> int:
    return next((code for kind, code in EXIT_CODES if isinstance(error, kind)), 49)
