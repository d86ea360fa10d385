"""Training-data operators: chat formatting, near-duplicate and repeat removal,
language identification, HTML text, secrets, packing, token counts and
benchmark decontamination.  Nothing else in ``lading`` imports this package."""
