"""End-to-end jobs and the queries that check them."""
