"""docweft: curation of paired code-and-documentation changes, as Spark plans."""

__version__ = "0.1.0"
