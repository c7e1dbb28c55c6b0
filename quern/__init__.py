"""quern: curation, evaluation and training-data operators as PySpark DataFrame plans."""
