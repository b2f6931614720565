"""Activity analytics on Spark: periods, evidence, bounded documents and report rules as DataFrame operators."""
