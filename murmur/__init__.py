"""Social-activity analytics on Spark: change feeds in, checked marts out."""
