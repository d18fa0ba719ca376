"""Every operator and dataset as a query over the star-schema tables, with an SQL twin."""
