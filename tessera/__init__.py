"""tessera: spreadsheet, workflow, notebook and statistics operators as Spark plans."""

__version__ = "0.1.0"
