"""DataFrame -> DataFrame operators (search, enrich, viewing, merge, insights)."""
