"""pagewright: document structuring and training-data analytics as Spark DataFrame operators."""
