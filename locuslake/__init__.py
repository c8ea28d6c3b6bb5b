"""Spark-native analytics over allele counts, read depth and genomic intervals."""
