"""Answer-type prediction and ranked retrieval as PySpark DataFrame operators."""
