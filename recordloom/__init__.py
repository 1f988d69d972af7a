"""recordloom: a Spark library that integrates records about the same real-world
entities from several sources (clean, validate, version, audit, resolve, merge, publish)."""
