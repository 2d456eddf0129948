"""Turn tables or streams of fetched web pages into an article corpus, on Spark."""
