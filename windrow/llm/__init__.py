"""Operations on text corpora for training language models."""
