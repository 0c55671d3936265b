"""The warehouse's fixed pipelines: silver, gold, analytics, quality."""
