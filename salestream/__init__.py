"""Sales-stream analytics on Spark: one windowed aggregation shared by batch and
Structured Streaming, a serving table that stays correct when windows are
re-emitted, and the business reports over it."""
