"""Value lookups, keyword classification, catalog search, carts and records as Spark jobs."""
