"""Tables: catalogues, parquet, JDBC, SQL views."""
