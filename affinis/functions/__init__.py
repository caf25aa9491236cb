"""Column functions: text, phonetic codes and similarities."""
