"""presslake: build and audit news corpora about events, as Spark DataFrame operators."""
