"""The queries the driver runs, by area, each with its SQL check where SQL can express it.

Every module holds ``QUERIES`` (name to a function of session and data folder) and ``ORACLES`` (name to SQL).
"""

from registry import curation, models, shards, speakers, streams, text_tokens, training

AREAS = (curation, text_tokens, speakers, shards, training, models, streams)
