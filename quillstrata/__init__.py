"""quillstrata: a corpus analytics engine written for PySpark."""
