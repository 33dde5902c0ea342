"""The same models on streams: micro-batch merges, watermarked roll-ups and keyed state."""
