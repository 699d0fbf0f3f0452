"""skyloom: Spark jobs that turn aerial-survey photos into leak-free detection datasets."""
