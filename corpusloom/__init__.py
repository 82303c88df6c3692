"""corpusloom: document-library analytics and training-data curation on PySpark."""
