"""Bibliographic RDF records: from XML text or files to (file, title, abstract)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import SPACE, let, strip
from ..operators.ranking import sample_n

# --- Fixed values: they decide results and must stay as they are. -------------
NAMESPACES = {
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "dc": "http://purl.org/dc/elements/1.1/",
    "dcterms": "http://purl.org/dc/terms/",
    "cinii": "https://cir.nii.ac.jp/schema/1.0/",
}
TITLE, ABSTRACT = "dc:title", ("cinii:description", "cinii:notation")
SECOND_CHOICE_LANGUAGE = "en"
PATTERN = "*.rdf"
RECORD_END = "</rdf:RDF>"
# ------------------------------------------------------------------------------

MARK = "\ufffe"  # in no XML text, between what one XPath gives


def _declares_otherwise(xml: Column) -> Column:
    """Whether a known namespace may have another prefix than ours, or none."""
    known = "|".join(rf"\Q{uri}\E" for uri in NAMESPACES.values())
    others = "".join(rf"|:(?!{prefix}\s*=)[\w.-]+\s*=\s*[\"']\Q{uri}\E[\"']"
                     for prefix, uri in NAMESPACES.items())
    return xml.rlike(rf"xmlns(?:\s*=\s*[\"'](?:{known})[\"']{others})")


def with_known_prefixes(xml: Column) -> Column:
    """Rename a record's own prefixes for the known namespaces to ours, inside tags only.

    XPath sees prefixes, not namespaces. Records that use the usual prefixes,
    nearly all, are passed on untouched. A default namespace is known on the root,
    where it holds for all names without prefix, and on an element without children.
    """
    def renamed(xml: Column, prefix: str, uri: str) -> Column:
        own = F.regexp_extract(xml, rf"xmlns:([\w.-]+)\s*=\s*[\"']\Q{uri}\E[\"']", 1)
        tags = F.regexp_replace(xml, F.concat(F.lit("(</?)"), own, F.lit(":")),
                                F.lit(f"$1{prefix}:"))
        attributes = F.regexp_replace(
            tags, F.concat(F.lit(r"(\s)"), own, F.lit(r""":(?=[\w.-]+\s*=\s*["'][^<>]*>)""")),
            F.lit(f"$1{prefix}:"))
        return F.when(~own.isin("", prefix), attributes).otherwise(xml)

    def given(xml: Column, prefix: str, uri: str) -> Column:
        default = rf"\sxmlns\s*=\s*[\"']\Q{uri}\E[\"']"
        on_root = xml.rlike(rf"^(?:\s*<[?!][^>]*>)*\s*<[^>]*{default}")
        everywhere = F.regexp_replace(xml, r"(</?)(?=[\p{L}_][\w.-]*[\s/>])", f"$1{prefix}:")
        alone = F.regexp_replace(
            xml, rf"<([\p{{L}}_][\w.-]*)([^<>]*{default}[^<>]*)>([^<]*)</\1\s*>",
            f"<{prefix}:$1$2>$3</{prefix}:$1>")
        return F.when(on_root, everywhere).when(xml.rlike(default), alone).otherwise(xml)

    # Each step reads the text several times, so it is bound to a name, not repeated.
    def all_steps(xml: Column) -> Column:
        for prefix, uri in NAMESPACES.items():
            for step in (renamed, given):
                xml = let(xml, lambda x: step(x, prefix, uri))
        return xml

    return let(xml, lambda x: F.when(~_declares_otherwise(x), x).otherwise(all_steps(x)))


def extract_record(df: DataFrame, file: str, xml: str, *keep: str) -> DataFrame:
    """(file, title, abstract, corrupt, keep...) of each XML text.

    The title is the first one not marked English, else the first one. XML that
    cannot be parsed gives nulls and is kept in ``corrupt``. Every XPath parses its text, so
    one gives all that is asked for, unless CDATA or comments may cut a text in pieces.
    """
    every = f"//*[name()='{TITLE}']"
    preferred = f"({every}[not(@*[name()='xml:lang']='{SECOND_CHOICE_LANGUAGE}')])[1]"
    outer, inner = ABSTRACT
    notation = f"(//*[name()='{outer}']/*[name()='{inner}'])[1]"

    def first_text(path: str) -> Column:
        return F.get(F.xpath("_xml", F.lit(f"{path}/text()[1]")), F.lit(0))

    parsed = F.from_xml(F.col("_xml"), "_bad string", {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = (df.withColumn("_xml", with_known_prefixes(F.col(xml)))
            .withColumn("_bad", parsed["_bad"]))
    # xpath fails the job on malformed text, so it only sees what parsed.
    sound = F.col("_bad").isNull() & F.col("_xml").isNotNull()
    whole = sound & ~F.contains("_xml", F.lit("<!"))
    title = F.when(F.xpath_boolean("_xml", F.lit(f"boolean({preferred})")),
                   first_text(preferred)).otherwise(first_text(f"({every})[1]"))
    asked = [f"boolean({preferred})"] + [
        f"{path}/text()[1]" for path in (preferred, f"({every})[1]", notation)]
    at_once = F.xpath_string("_xml", F.lit("concat(" + f", '{MARK}', ".join(asked) + ")"))
    rows = rows.withColumn("_found", F.when(whole, F.split(at_once, MARK)))

    def found(place: int) -> Column:
        # Only CDATA can be an empty text.
        return F.nullif(F.get("_found", F.lit(place)), F.lit(""))

    def stripped(c: Column) -> Column:
        return F.when(F.left(c, F.lit(1)).rlike(SPACE) | F.right(c, F.lit(1)).rlike(SPACE),
                      strip(c)).otherwise(c)

    return rows.select(
        F.col(file).alias("file"),
        F.when(whole, F.when(F.get("_found", F.lit(0)) == "true", found(1)).otherwise(found(2)))
        .when(sound, title).alias("title"),
        F.when(whole, stripped(found(3)))
        .when(sound, strip(first_text(notation))).alias("abstract"),
        F.col("_bad").alias("corrupt"), *keep)


def read_options(pattern: str, record_end: str | None) -> dict:
    """Options of the text source for record files.

    One record per file by default. With ``record_end`` a file may hold many
    records one after the other, and large files are split between tasks.
    """
    options = {"pathGlobFilter": pattern, "recursiveFileLookup": "true"}
    return options | ({"lineSep": record_end} if record_end else {"wholetext": "true"})


def as_xml(df: DataFrame, record_end: str | None, modified: str | None = None) -> DataFrame:
    """(file, xml) from what the text source read, batch or stream; with ``modified`` the time
    of the file under that name."""
    xml = strip(F.col("value"))
    if record_end:
        df = df.where(F.col("value").rlike(r"\S"))
        xml = F.concat("value", F.lit(record_end))
        # What does not end with space needs no search for it.
        xml = strip(xml) if record_end[-1].isspace() else F.regexp_replace(xml, rf"^{SPACE}+", "")
    time = [F.col("_metadata.file_modification_time").alias(modified)] if modified else []
    return df.select(F.col("_metadata.file_path").alias("file"), xml.alias("xml"), *time)


def scan_files(spark: SparkSession, root: str | list[str], pattern: str = PATTERN,
               record_end: str | None = None) -> DataFrame:
    """(file, xml) of every matching file below ``root``."""
    found = spark.read.format("text").options(**read_options(pattern, record_end)).load(root)
    return as_xml(found, record_end)


def sample_files(spark: SparkSession, root: str, n: int | None, seed: int = 42,
                 pattern: str = PATTERN) -> DataFrame:
    """(file) of exactly ``n`` files, drawn by name; only names are read."""
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
              .option("recursiveFileLookup", "true").load(root)
              .select(F.col("_metadata.file_path").alias("file")))
    return sample_n(listed, "file", n, seed)


def scan_records(spark: SparkSession, root: str, pattern: str = PATTERN,
                 record_end: str | None = None, max_files: int | None = None,
                 seed: int = 42) -> DataFrame:
    """(file, title, abstract, corrupt) of every record below ``root``.

    With ``max_files`` only the files of the sample are opened; their names, at most so
    many, go through the driver.
    """
    if max_files is not None:
        names = [r["file"] for r in sample_files(spark, root, max_files, seed, pattern).collect()]
        if not names:
            return extract_record(scan_files(spark, root, pattern, record_end).limit(0),
                                  "file", "xml")
        root = names
    return extract_record(scan_files(spark, root, pattern, record_end), "file", "xml")


def xml_text(c: Column) -> Column:
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return c


def to_record(titles: list[tuple[Column, str | None]], abstract: Column) -> Column:
    """An RDF record as XML: titles with their language mark, and a notation."""
    marks = [F.concat(F.lit("<dc:title" + (f' xml:lang="{lang}"' if lang else "") + ">"),
                      xml_text(title), F.lit("</dc:title>")) for title, lang in titles]
    names = " ".join(f'xmlns:{prefix}="{uri}"' for prefix, uri in NAMESPACES.items())
    return F.concat(
        F.lit(f"<rdf:RDF {names}><rdf:Description>"),
        # concat_ws leaves out titles that are null.
        F.concat_ws("", *marks),
        F.coalesce(F.concat(F.lit("<cinii:description><cinii:notation>"), xml_text(abstract),
                            F.lit("</cinii:notation></cinii:description>")), F.lit("")),
        F.lit("</rdf:Description></rdf:RDF>"))
