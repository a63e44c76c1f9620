"""Streaming.

The reference has no stream source, watermark, time window or stateful operator
``DataFrame -> DataFrame`` functions over built-in expressions, so the
row-wise ones (filters, projections, scalar helpers in ``sparkdeck.functions``) apply
unchanged to a ``readStream`` frame; the ordered operators need a bounded input.
"""
