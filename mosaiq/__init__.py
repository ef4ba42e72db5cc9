"""A Spark-native analytics engine: a federated catalog of typed entities that
is queried by SQL or a fluent builder."""
