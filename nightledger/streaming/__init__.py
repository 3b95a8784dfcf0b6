"""File-drop ingestion: daily files picked up by a Structured Streaming
file source and handed to the daily run."""
