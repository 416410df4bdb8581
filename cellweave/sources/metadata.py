"""Channel names and image facts out of metadata documents."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.functions.names import file_name, file_stem

_OME_TYPE = T.StructType([
    T.StructField("channels", T.ArrayType(T.StringType())), T.StructField("n_images", T.LongType()),
    T.StructField("n_channels", T.LongType()),
    T.StructField("pixels_attributes", T.MapType(T.StringType(), T.StringType())),
    T.StructField("error", T.StringType())])


@F.pandas_udf(_OME_TYPE)
def ome_facts(xml: pd.Series) -> pd.DataFrame:
    """Facts of each OME-XML document. Malformed text must not fail the job, so its error
    is kept as text; the built-in XPath functions would raise."""
    rows = []
    for text in xml:
        row = {"channels": None, "n_images": None, "n_channels": None, "pixels_attributes": None, "error": None}
        if text is not None:
            try:
                root = ET.fromstring(text.encode("utf-8"))
                channels = root.findall(".//{*}Channel")
                pixels = root.find(".//{*}Pixels")
                row.update(channels=[c.attrib.get("Name", f"Channel_{i}") for i, c in enumerate(channels)],
                           n_images=len(root.findall(".//{*}Image")), n_channels=len(channels),
                           pixels_attributes=dict(pixels.attrib) if pixels is not None else None,
                           error=None if pixels is not None else "no Pixels element")
            except ET.ParseError as e:
                row["error"] = str(e)
        rows.append(row)
    return pd.DataFrame(rows, columns=["channels", "n_images", "n_channels", "pixels_attributes", "error"])


def ome_summary(documents: DataFrame, xml: str, keys: list[str]) -> DataFrame:
    """Images, channels and pixel attributes per document, or the parse error."""
    return (documents.select(*keys, ome_facts(F.col(xml)).alias("ome"))
            .select(*keys, "ome.n_images", "ome.n_channels", "ome.pixels_attributes", "ome.error"))


def _object_names(text: Column, *fields: str) -> Column:
    """Names of a JSON list of channel objects, numbered where an object has none.

    Objects are read as maps: field names that differ only by case are different keys.
    """
    return F.transform(
        F.from_json(text, "array<map<string,string>>"),
        lambda e, i: F.coalesce(*[F.try_element_at(e, F.lit(f)) for f in fields],
                                F.concat(F.lit("Channel_"), i.cast("string"))))


def channel_names(doc: Column, xml_names: Column) -> Column:
    """Channel names of a metadata document; the first known key it has decides.

    ``xml_names`` are the names read from the document's ``ome_xml``. Null where the
    deciding key holds no names.
    """
    def part(path: str) -> Column:
        return F.get_json_object(doc, path)

    def has(text: Column, key: str) -> Column:
        return F.coalesce(F.array_contains(F.json_object_keys(text), key), F.lit(False))

    def is_list(text: Column) -> Column:
        return F.coalesce(text.startswith("["), F.lit(False))

    def strings(text: Column) -> Column:
        return F.from_json(text, "array<string>")

    listed, nested = part("$.channels"), part("$.image.channels")
    ome, panel, markers = part("$.ome.Image.Pixels.Channel"), part("$.panel"), part("$.markers")
    names = (F.when(has(doc, "channel_names"), strings(part("$.channel_names")))
             .when(has(doc, "channels") & is_list(listed), _object_names(listed, "name", "Name"))
             .when(has(part("$.image"), "channels"), F.when(is_list(nested), _object_names(nested, "name", "Name")))
             .when(has(doc, "ome"), F.when(is_list(ome), _object_names(ome, "Name")))
             .when(has(doc, "panel"), F.when(is_list(panel), strings(panel)).otherwise(strings(part("$.panel.targets"))))
             .when(has(doc, "markers") & is_list(markers), strings(markers))
             .when(has(doc, "ome_xml"), xml_names))
    return F.when(F.size(names) > 0, names)


def scan_channel_meta(documents: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """One row per document and channel, in channel order, from JSON texts."""
    xml = F.get_json_object(F.col(text), "$.ome_xml")
    facts = documents.withColumn("ome", F.when(xml.isNotNull(), ome_facts(xml)))
    return (facts.select(*keys, F.posexplode(channel_names(F.col(text), F.col("ome.channels")))
                         .alias("channel_index", "channel_name")))


def read_documents(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Whole JSON files as (file_name, text)."""
    return (spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob)
            .text(path).select(file_name(F.col("_metadata.file_path")).alias("file_name"), F.col("value").alias("text")))


def match_documents(images: DataFrame, documents: DataFrame, path: str = "path") -> DataFrame:
    """Metadata document of each image: the first of three file name patterns that exists."""
    base = file_stem(F.col(path))
    patterns = F.array(F.concat(base, F.lit("_metadata.json")), F.concat(base, F.lit(".json")),
                       F.concat(F.lit("metadata_"), base, F.lit(".json")))
    tried = images.select("*", F.posexplode(patterns).alias("pattern", "file_name"))
    # Names meet first; the texts, which may be large, only join the one that was found.
    best = (tried.join(documents.select("file_name"), "file_name", "left_semi").groupBy(*images.columns)
            .agg(F.min_by("file_name", "pattern").alias("file_name")))
    return best.join(documents, "file_name").select(*images.columns, "file_name", "text")
