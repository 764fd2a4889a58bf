"""Writers: plain, partitioned, partition replace, upsert, logged."""
