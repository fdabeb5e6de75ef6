"""assay: governed bronze/silver/gold data products as plain PySpark DataFrame functions."""
