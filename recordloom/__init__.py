"""Record bundles to versioned, query-ready tables, written as Spark DataFrame code."""
