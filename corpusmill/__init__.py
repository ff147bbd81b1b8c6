"""A PySpark-native engine that builds and audits text corpora."""
