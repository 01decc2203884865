"""Sound labels by category."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words in a sound's label, by the category that they stand for; the first category with one counts.
KEYWORDS = {
    "speech": "speech conversation narration monologue talk whispering shout yell",
    "music": "music song singing guitar piano drum orchestra melody choir violin",
    "applause": "applause clapping cheering",
    "crowd": "crowd chatter hubbub babble stadium",
    "traffic": "vehicle car traffic engine motor truck bus horn siren train aircraft",
    "explosion": "explosion gunshot fireworks bang boom blast",
    "footsteps": "footsteps walk running stomp",
    "animal": "dog cat bird animal bark meow horse cow insect",
    "environmental": "wind rain thunder water waves ocean fire leaves noise",
    "silence": "silence",
}


def category(label: Column) -> Column:
    """The category of a sound's label; other if no word says one, null with null."""
    low = F.lower(label)
    return F.when(label.isNotNull(), F.coalesce(*[F.when(low.rlike("|".join(words.split())), F.lit(name)) for name, words in KEYWORDS.items()], F.lit("other")))
