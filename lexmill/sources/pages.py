"""Page-text sources: every source gives ``doc_id, page_no bigint, text string``."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A corpus in the shape of manuals, derived from ``part``; the same text runs in Spark and DuckDB.
MANUAL_SQL = """with p as (select p_partkey % 50 as doc_id, p_partkey, p_name, p_brand, p_type, cast(p_size as int) as sz,
   row_number() over (partition by p_partkey % 50 order by p_partkey) as k from part),
body as (select doc_id, k + 1 as page_no, concat_ws(chr(10),
  case when k = 1 and p_partkey % 2 = 0 then 'intro text for this manual' end,
  case when k % 5 = 1 then concat(cast(k as string), ' GENERAL DATA') end,
  concat(cast(k as string), '.1 ', p_name),
  case when p_partkey % 3 = 0 then concat(cast(k as string), '.1.2 Details') end,
  case p_partkey % 6
   when 0 then concat('Weight ..... ', cast(sz as string), ' kg', chr(10), 'Width .... ', cast(sz as string), ' mm', chr(10), 'Depth ... ', cast(sz as string), ' mm', chr(10), cast(k as string), '.1.3 More', chr(10), 'Length ..... ', cast(sz as string), ' mm', chr(10), 'Volume ..... ', cast(sz as string), ' ml', chr(10), 'Load ..... ', cast(sz as string), ' kg')
   when 1 then concat('Name | Type | Size', chr(10), p_name, ' | ', p_type, ' | ', cast(sz as string))
   when 2 then concat('1. ', p_type, chr(10), '2) ', p_name)
   when 3 then concat('WARNING: never mix ', p_name, ' with water. Keep dry.')
   when 4 then concat('Rating plates', chr(10), 'KRUPS, EU-version', chr(10), cast(sz as string), ' Hz', chr(10), 'Magimix', chr(10), '120 V')
   else concat('Cleaning Steps', chr(10), 'rinse the ', p_name, ' with clean water every single day.', chr(10), 'Storage', chr(10), 'store the ', p_name, ' in a dry and dark place at home.') end,
  '-----', cast(k + 1 as string)) as text from p),
n as (select doc_id, count(*) as c from p group by doc_id)
select doc_id, cast(page_no as bigint) as page_no, text from body
union all select doc_id, cast(1 as bigint), 'COVER PAGE' from n
union all select doc_id, cast(c + 2 as bigint), 'BACK PAGE' from n"""


def manual_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MANUAL_SQL.replace(" from part)", " from {part})"), part=spark.read.parquet(f"{sf_dir}/part.parquet"))


#: A second corpus from ``part``: one section a page, with the cases that the first has not (marks and both kinds of separators in
#: table runs, cells to be quoted, runs that are no table, implicit headings that repeat or look numbered).
ODD_SQL = """with p as (select p_partkey % 50 as doc_id, p_partkey, p_name, row_number() over (partition by p_partkey % 50 order by p_partkey) as k from part)
select doc_id, cast(k as bigint) as page_no, concat_ws(chr(10), concat(cast(k as varchar(20)), '.1 ', p_name), case p_partkey % 8
   when 0 then concat('Weight, net ..... 5 "kg"', chr(10), '- see note', chr(10), 'Width .... 3 mm', chr(10), '* all sizes', chr(10), 'Depth ... 4 mm')
   when 1 then concat('- a ..... 1', chr(10), '- b .... 2', chr(10), '- c ... 3')
   when 2 then concat('Name | Type | Size', chr(10), 'x | y ... z | 4', chr(10), 'q | r | s')
   when 3 then concat('A ..... 1', chr(10), 'B | C .... 2', chr(10), 'D ... 3')
   when 4 then concat('A ... 1', chr(10), 'B ... x ... 2', chr(10), 'C ... x ... y ... 3')
   when 5 then concat('a "b" | c, d | e', chr(10), 'f | | g', chr(10), '| h | i | j |')
   when 6 then concat('Step One', chr(10), 'fill the tank with cold and clean water first.', chr(10), 'Step One', chr(10), 'wait until the light is on and does not blink.', chr(10), 'Step One 2', chr(10), 'press the large key and hold it for a moment.')
   else concat('Step One', chr(10), 'fill the tank with cold and clean water first.', chr(10), 'Step One', chr(10), 'wait until the light is on and does not blink.', chr(10), 'Step One', chr(10), 'press the large key and hold it for a moment.') end) as text from p"""


def odd_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ODD_SQL.replace(" from part)", " from {part})"), part=spark.read.parquet(f"{sf_dir}/part.parquet"))


def document_pages(documents: DataFrame) -> DataFrame:
    """One page for each document."""
    return documents.select("doc_id", F.lit(1).cast("long").alias("page_no"), F.coalesce("text", F.lit("")).alias("text"))


def conversation_pages(conversations: DataFrame) -> DataFrame:
    """One document for each conversation, a page for each turn."""
    return conversations.select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).alias("page_no"), F.coalesce("text", F.lit("")).alias("text"))


def files(spark: SparkSession, where: str | list[str], glob: str = "*.pdf") -> DataFrame:
    """Files of a folder that match a glob (not recursive), or listed files, with source metadata, in no order."""
    reader = spark.read.format("binaryFile")
    df = reader.load(where) if isinstance(where, list) else reader.option("pathGlobFilter", glob).load(where)
    name = F.element_at(F.split("path", "/"), -1)
    return df.select("path", name.alias("filename"), F.regexp_replace(name, "\\.[^.]*$", "").alias("stem"), F.sha2("content", 256).alias("checksum_sha256"), "content")


def listing(found: DataFrame) -> DataFrame:
    """The files by path, without their contents, which a sort would shuffle."""
    return found.drop("content").orderBy("path")


def text_file_pages(found: DataFrame) -> DataFrame:
    """Pages of UTF-8 text files: form feeds part the pages."""
    page = F.posexplode(F.split(F.decode("content", "UTF-8"), "\\f", -1)).alias("i", "text")
    return found.select(F.col("stem").alias("doc_id"), page).select("doc_id", (F.col("i") + 1).cast("long").alias("page_no"), "text")


def pdf_pages(found: DataFrame) -> DataFrame:
    """Pages of PDF files where a PDF library is installed; a file that fails is a row with ``error``."""
    import pandas as pd

    def run(batches):
        try:
            from io import BytesIO

            from pypdf import PdfReader
        except ImportError:
            PdfReader = None
        for pdf in batches:
            rows = []
            for stem, content in zip(pdf["stem"], pdf["content"], strict=True):
                try:
                    if PdfReader is None:
                        raise RuntimeError("no PDF library is installed")
                    rows += [(stem, i, p.extract_text() or "", None) for i, p in enumerate(PdfReader(BytesIO(content)).pages, 1)]
                except Exception as e:  # one bad document doesn't end the run
                    rows.append((stem, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["doc_id", "page_no", "text", "error"])

    return found.select("stem", "content").mapInPandas(run, "doc_id string, page_no long, text string, error string")
