"""Models and the queries over them."""
