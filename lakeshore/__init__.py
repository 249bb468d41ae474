"""lakeshore: medallion-style lakehouse operators as Spark DataFrame/SQL plans."""
__version__ = "0.1.0"
