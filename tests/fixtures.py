"""Hand-checked inputs from FIXTURES.md."""

from pyspark.sql import functions as F

from wordmill import schemas

CHANNEL_LIST = [
    ("v1", "Debata: wybory 2025", "Rozmowa o gospodarce", "2025-01-29T10:00:00Z", "UCa", "Radio A"),
    ("v2", "Poranek", None, "2025-01-30T00:00:00Z", "UCa", "Radio A"),
    ("v3", "Sport", "WYBORY w tle", "2025-01-28T23:59:59Z", "UCa", "Radio A"),
]
PLAYLIST_LIST = [
    ("v4", "Wywiad", "kultura", "2025-01-30T12:30:00Z", "UCb", "Radio B"),
    ("v1", "Debata: wybory 2025", "Rozmowa o gospodarce", "2025-01-29T10:00:00Z", "UCa", "Radio A"),
    ("v5", "Wybory", "x", None, "UCb", "Radio B"),
    ("v6", "Raport", "dane", "not-a-date", "UCb", "Radio B"),
]
TRANSCRIPTS = [
    ("UCa", "v1", "[0:00] Kot widzi psa.\n[0:07] Pies widzi kota, KOT!"),
    ("UCa", "v2", "[75:03] pies i kot"),
    ("UCb", "v4", "[0:01] kot oraz dom"),
]


def videos(spark, rows):
    return spark.createDataFrame(rows, schemas.VIDEOS)


def transcripts(spark):
    return spark.createDataFrame(TRANSCRIPTS, schemas.TRANSCRIPTS)


def assemble(blocks, keys=("video_id",), text_col="text"):
    """Test oracle only: join a video's blocks into its whole text (the
    group is the whole video, which the library never builds)."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col("block").alias("b"), F.col(text_col).alias("t"))))
    return blocks.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda s: s["t"]), "\n").alias(text_col))
