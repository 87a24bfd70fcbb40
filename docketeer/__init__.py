"""Court-verdict enrichment on Spark: name normalization, one-vs-rest naive Bayes
categories and name/category reports, all as DataFrame jobs."""
