"""broadsheet: document-enrichment and analytics operators on PySpark DataFrames."""
