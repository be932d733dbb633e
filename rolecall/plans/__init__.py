"""Questions about the posting table, and the batch ingestion job."""
