"""The three end-to-end flows: collect, extract, audit."""
