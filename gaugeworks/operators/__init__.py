"""DataFrame operators: flattening, joins, frames, marts, materialisation."""
