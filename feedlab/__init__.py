"""Product analytics and online experiments on event logs, as Spark jobs."""
