"""inkweave: a PySpark engine for building and auditing bilingual page-scan corpora."""
