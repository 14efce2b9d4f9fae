"""Where sale events come from: streams, bounded replays, and looks at a topic."""

from salestream.sources.readers import peek, read_batch, read_stream
from salestream.sources.topic import offset_gaps, partition_profile

__all__ = ["offset_gaps", "partition_profile", "peek", "read_batch", "read_stream"]
