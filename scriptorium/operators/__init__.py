"""DataFrame -> DataFrame steps: cleaning, packing, chat/SFT, split, batches, global order."""
