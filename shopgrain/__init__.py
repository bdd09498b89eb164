"""Shop analytics on Spark: customer questions, star-schema loads, trips, layouts and audits."""
