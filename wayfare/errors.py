"""Error types of the engine."""


class ContractViolation(Exception):
    """Data breaks a rule that a stage or loader relies on."""


class WriteViolation(Exception):
    """A write outside the folder that is open for writing."""


class UpstreamMissing(Exception):
    """A stage's input has no published version."""


class UpstreamCorrupt(Exception):
    """A published output no longer has the hash in its manifest."""
