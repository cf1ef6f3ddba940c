"""Order analytics on Spark: conforming, facts, customer and sales marts, reports."""
