"""DataFrame -> DataFrame operators: vault loads, rates, mart, upsert, quality."""
