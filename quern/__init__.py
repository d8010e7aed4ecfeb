"""quern: a Spark-native engine for building and auditing training corpora."""
