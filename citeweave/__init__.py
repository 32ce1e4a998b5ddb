"""A Spark-native engine that builds citation-evidence corpora from articles and bibliographic tables."""
