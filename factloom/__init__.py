"""factloom: Spark-native operators that turn documents into an auditable table of facts."""
