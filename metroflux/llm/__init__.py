"""Training-data pipeline operators (deduplication, decontamination, WARC,
similarity join, classifiers, sharding, tokenisation).  Nothing else in the
library imports this package."""
