"""Column functions: text cleaning, token sequences, word lists."""
