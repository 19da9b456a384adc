"""Errors that stop a run."""


class IngestError(Exception):
    """Base class of every condition that ends a run early."""


class NoSourceFiles(IngestError):
    """The inbox holds no unprocessed file."""


class NoCsvFiles(IngestError):
    """The inbox holds files, but none with the .csv extension."""


class NoValidFiles(IngestError):
    """Every CSV file lacks at least one mandatory column."""


class UnfinishedRun(IngestError):
    """An earlier run opened files in the ledger and never closed them."""


class DuplicateKeys(IngestError):
    """A dimension has more than one row for a key."""
