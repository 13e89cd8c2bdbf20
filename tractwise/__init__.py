"""Small-area labour-market analytics as parameterised Spark DataFrame operators."""
