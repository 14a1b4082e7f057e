"""tidewire: Spark-native curation and enrichment of multilingual news corpora."""
