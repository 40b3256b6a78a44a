"""costlake: cloud cost-and-usage analytics on Spark."""
