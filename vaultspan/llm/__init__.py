"""Operations for building text corpora for language models, as Spark jobs."""
