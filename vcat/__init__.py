"""vcat: a Spark-native engine for versioned, content-hashed data catalogues."""
