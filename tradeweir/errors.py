"""Errors a pipeline run can raise. Each names the boundary that refused to go on."""


class PipelineError(RuntimeError):
    """Base class of every refusal in this package."""


class IdentifierError(PipelineError, ValueError):
    """A table name is not a plain dotted identifier."""


class RoleError(PipelineError):
    """A job was pointed at a table that belongs to another job."""


class ContractError(PipelineError):
    """Columns or types differ from the declared contract."""


class SnapshotError(PipelineError):
    """A snapshot could not be resolved or read."""


class NullsFoundError(PipelineError):
    """Required columns hold nulls."""


class CopyMismatchError(PipelineError):
    """Two datasets that must be equal are not."""


class PublishError(PipelineError):
    """A serving publication stopped before or after the swap."""


class CheckpointEpochError(PipelineError, ValueError):
    """A stream was given the checkpoint of a retired epoch."""
