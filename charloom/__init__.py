"""charloom: character-level sequence modelling over Spark tables.

Corpus preparation, vocabularies, training windows, recurrent-model training
(full batch, sampled mini-batches, local training with parameter averaging),
scoring and batch generation, all expressed as Spark DataFrame jobs.
"""

from charloom.config import RnnConfig

__all__ = ["RnnConfig"]
