"""What the operators refuse."""


class TableMirrorError(ValueError):
    """Base of every refusal."""


class SchemaError(TableMirrorError):
    """Source and target differ in names or types, or a type cannot be compared."""


class KeyCheckError(TableMirrorError):
    """A key is null or occurs more than once."""


class MissingKeysError(TableMirrorError):
    """A required row is absent from the source."""


class RuleError(TableMirrorError):
    """A prefix or rule list is malformed."""


class EmptySourceError(TableMirrorError):
    """A mirror would delete a whole scope because the source has no row in it."""


class ScanError(TableMirrorError):
    """A folder is missing, or its storage cannot be listed in full."""


class PatchError(TableMirrorError):
    """A change set was made for other rows than those it is applied to."""


class PublishError(TableMirrorError):
    """A version was not published; the store is as before."""


class EmptyMessageError(PublishError):
    pass


class NothingChangedError(PublishError):
    pass


class StaleParentError(PublishError):
    pass
