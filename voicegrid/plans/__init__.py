"""Query catalogue: Spark queries and the SQL that checks them."""
