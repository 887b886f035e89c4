"""Series and stream similarity as Spark jobs.

Three groups of work, all DataFrame in -> DataFrame out:

* clean a panel of daily series and put it on a weekday calendar,
* compare every series with the mean, minimum and maximum of every pair of
  topics by cosine similarity, and report the best matches,
* find similar streams in a feed with a windowed Count-Min sketch, in batch
  and in Structured Streaming.
"""

from tidepair.session import build_session, materialize, shared_folder

__all__ = ["build_session", "materialize", "shared_folder"]
