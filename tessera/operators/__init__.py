"""Jobs over DataFrames: ingest, views, filters and integration. All are lazy unless they say so."""
