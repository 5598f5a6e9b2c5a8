"""Training-data operators: one module an operator, and the queries that apply them."""
