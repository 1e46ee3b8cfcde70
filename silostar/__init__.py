"""silostar: sales-warehouse loading, data quality and publication on Spark."""
