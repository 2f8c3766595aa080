"""skein: content curation and text analytics as declarative Spark plans."""
