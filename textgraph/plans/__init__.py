"""How plans are shaped for scale: lineage cuts, joins that stand hot keys, bounded groups."""
