"""News analytics and price features as PySpark DataFrame operators."""
