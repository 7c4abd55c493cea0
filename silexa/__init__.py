"""Document-corpus analytics on PySpark: DataFrame in, DataFrame out."""
