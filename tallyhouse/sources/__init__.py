from tallyhouse.sources.tables import TableSet

__all__ = ["TableSet"]
