"""Where results go: message topics, document stores and the emission log."""

from salestream.sinks.batch import append_deltas, append_documents, write_batch, write_windows
from salestream.sinks.envelope import publish, to_envelope

__all__ = ["append_deltas", "append_documents", "publish", "to_envelope", "write_batch", "write_windows"]
