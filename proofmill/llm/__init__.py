"""Training-data operators. Nothing outside this folder, the pipeline and the entry point imports them."""
