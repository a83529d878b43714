"""lexstat: corpus statistics and lexical resources as Spark DataFrame plans."""
