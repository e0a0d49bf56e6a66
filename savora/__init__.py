"""Review analytics, feature building, retrieval and recommendation as Spark jobs."""
