"""Raw inputs: delimited files, polygon layers, fixture derivations."""
