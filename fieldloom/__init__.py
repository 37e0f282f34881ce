"""fieldloom: labelled web pages to validated, structured records, as Spark DataFrame plans."""

__version__ = "0.1.0"
