"""Streaming.

The reference reads bounded files only: it has no stream source, watermark,
window or state, so this package deliberately holds no operator. The batch
operators are plain DataFrame transformations and apply unchanged to a
micro-batch inside ``foreachBatch`` should a streaming source ever feed them.
"""
