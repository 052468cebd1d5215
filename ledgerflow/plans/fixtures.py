"""Input relations of the operators, derived from the benchmark tables.

Every relation covers its whole table, so the work of a query grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow import schemas
from ledgerflow.operators.attachments import with_file_key
from ledgerflow.operators.joins import lookup_join
from ledgerflow.operators.staging import staged
from ledgerflow.sources.tables import deal_out

NOW_TEXT = "2024-07-01 00:00:00"
START_TEXT = "2024-01-01 00:00:00"


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def now() -> Column:
    return ntz(NOW_TEXT)


def text_of(*parts: Column | str) -> Column:
    """Concatenate columns and literal texts."""
    return F.concat(*[
        F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts
    ])


def choose(index: Column, options: list[Column]) -> Column:
    """The option whose number ``index`` holds."""
    chosen = F.when(index == 0, options[0])
    for number, option in enumerate(options[1:], start=1):
        chosen = chosen.when(index == number, option)
    return chosen


class Inputs:
    """Relations over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def dealt(self, name: str) -> DataFrame:
        """A table whose rows go into costly steps."""
        return deal_out(self.table(name))

    # -- messages and marks --------------------------------------------------
    def messages(self) -> DataFrame:
        """One message per event: folder = user, uid = event number from 1."""
        return self.table("events").select(
            F.col("user_id").alias("source_folder_id"),
            (F.col("event_id") + 1).alias("uid"),
            "event_type",
            "value",
        )

    def _span(self) -> DataFrame:
        return (
            self.messages()
            .groupBy("source_folder_id")
            .agg(F.min("uid").alias("low"), F.max("uid").alias("high"))
        )

    def state(self) -> DataFrame:
        """Marks per folder: NULL for first runs, idle folders, ends of backfill, one mark only."""
        folder, low, high = F.col("source_folder_id"), F.col("low"), F.col("high")
        three_quarters = low + F.floor((high - low) * 3 / 4)
        half = low + F.floor((high - low) / 2)
        first = folder % 3 == 0
        ten = folder % 10
        return self._span().select(
            "source_folder_id",
            F.when(first, F.lit(None)).when(ten == 2, high).otherwise(three_quarters)
            .cast("bigint").alias("high_water_mark"),
            F.when(first | (ten == 4), F.lit(None)).when(ten == 1, 1).when(ten == 5, 40)
            .otherwise(half).cast("bigint").alias("low_water_mark"),
        )

    def later_state(self) -> DataFrame:
        """Marks with which every folder is on a later run."""
        low, high = F.col("low"), F.col("high")
        return self._span().select(
            "source_folder_id",
            (low + F.floor((high - low) * 3 / 4)).cast("bigint").alias("high_water_mark"),
            (low + F.floor((high - low) / 2)).cast("bigint").alias("low_water_mark"),
        )

    def first_state(self) -> DataFrame:
        """No folder was read before."""
        nothing = F.lit(None).cast("bigint")
        return self._span().select(
            "source_folder_id",
            nothing.alias("high_water_mark"),
            nothing.alias("low_water_mark"),
        )

    def outcomes(self, selection: DataFrame) -> DataFrame:
        """What became of each selected message, with timings."""
        kind = F.col("event_type")
        status = (
            F.when(kind == "error", "failed")
            .when(kind == "purchase", "invoice")
            .when(kind == "signup", "no_extraction")
            .otherwise("non_invoice")
        )
        error = F.when(kind == "error", "malformed message").when(
            kind == "signup", "Invoice extraction returned None"
        )
        return self.messages().join(selection, ["source_folder_id", "uid"]).select(
            "source_folder_id",
            "uid",
            "chunk_num",
            status.alias("status"),
            error.alias("error"),
            (F.col("value") * 4).alias("duration_sec"),
            F.col("value").alias("classification_time_sec"),
            (F.col("value") * 2).alias("extraction_time_sec"),
            F.lit(0.25).alias("s3_upload_time_sec"),
            F.lit(0.75).alias("db_commit_time_sec"),
        )

    # -- sources, folders, users ---------------------------------------------
    def sources(self) -> DataFrame:
        key = F.col("c_custkey")
        expires = F.expr(
            f"timestampadd(HOUR, cast(floor(c_acctbal) as int), timestamp_ntz'{START_TEXT}')"
        )
        started = ntz(START_TEXT).cast("timestamp")
        return self.table("customer").select(
            key.alias("id"),
            F.col("c_nationkey").cast("string").alias("user_id"),
            F.col("c_name").alias("name"),
            text_of(F.lower("c_name"), "@example.com").alias("email_address"),
            F.when(F.col("c_mktsegment") == "BUILDING", "outlook").otherwise("gmail")
            .alias("source_type"),
            F.when(key % 9 != 0, F.when(key % 9 == 1, "").otherwise(text_of("held-", key)))
            .alias("oauth2_access_token"),
            text_of("renew-", key).alias("oauth2_refresh_token"),
            F.when(key % 7 != 0, expires).alias("oauth2_access_token_expires_at"),
            F.lit(None).cast("timestamp_ntz").alias("oauth2_refresh_token_expires_at"),
            started.alias("created_at"),
            started.alias("updated_at"),
        )

    def refreshes(self) -> DataFrame:
        """Refresh results: a new token, an empty one, an error, or nothing at all."""
        key = F.col("c_custkey")
        return self.table("customer").filter(key % 11 != 0).select(
            key.alias("source_id"),
            F.when(key % 4 != 0, F.when(key % 8 == 5, "").otherwise(text_of("new-", key)))
            .alias("new_token"),
            F.when(key % 4 == 0, "refresh refused").alias("error"),
        )

    def all_folders(self) -> DataFrame:
        """Two folders per source."""
        key = F.col("c_custkey")
        name = F.explode(F.array(F.lit("INBOX"), F.lit("Spam"))).alias("folder_name")
        started = ntz(START_TEXT).cast("timestamp")
        return self.table("customer").select(key, name).select(
            (key * 2 + F.when(F.col("folder_name") == "INBOX", 1).otherwise(2)).alias("id"),
            key.alias("source_id"),
            "folder_name",
            (key % 5).cast("string").alias("uid_validity"),
            F.when(key % 3 != 0, key + 100).alias("high_water_mark"),
            F.when(key % 3 != 0, key + 50).alias("low_water_mark"),
            F.lit(None).cast("timestamp").alias("last_processed_at"),
            started.alias("created_at"),
            started.alias("updated_at"),
        )

    def folders(self) -> DataFrame:
        """The folder table: some sources' folders are not known yet."""
        return self.all_folders().filter(F.col("source_id") % 4 != 0)

    def listing(self) -> DataFrame:
        """What the mailboxes list: new epochs, unknown folders, and folders listed twice."""
        key = F.col("source_id")
        once = self.all_folders().select(
            "source_id",
            F.col("folder_name").alias("name"),
            F.when(key % 6 == 0, (key % 5 + 100).cast("string"))
            .otherwise(F.col("uid_validity")).alias("uid_validity"),
        )
        return once.unionByName(once.filter(key % 10 == 0))

    def listing_lines(self) -> DataFrame:
        """Captured listing and status lines; some without quotes, status or number."""
        key = F.col("source_id")
        return self.all_folders().select(
            "source_id",
            F.when(key % 9 == 0, text_of('(\\HasNoChildren) "/" ', F.col("folder_name")))
            .otherwise(text_of('(\\HasNoChildren) "/" "', F.col("folder_name"), '"'))
            .alias("list_line"),
            F.when(key % 7 == 0, F.lit(None))
            .when(key % 13 == 0, text_of('"', F.col("folder_name"), '" (MESSAGES 3)'))
            .otherwise(text_of('"', F.col("folder_name"), '" (UIDVALIDITY ', key, ")"))
            .alias("status_line"),
        )

    def users(self) -> DataFrame:
        """The users of the sources; a few sources' users are gone."""
        key = F.col("c_nationkey")
        started = ntz(START_TEXT)
        return (
            self.table("customer").filter(key % 9 != 4).groupBy(key)
            .agg(F.min("c_name").alias("name"))
            .select(
                key.cast("string").alias("id"),
                "name",
                F.when(key % 8 == 3, "shared@example.com")
                .otherwise(text_of("user", key, "@example.com")).alias("email"),
                F.when(key % 6 != 5, F.lit(True)).alias("email_verified"),
                F.lit(None).cast("string").alias("image"),
                started.alias("created_at"),
                started.alias("updated_at"),
            )
        )

    def invoices(self) -> DataFrame:
        """One invoice per order, in the table's columns; numbers repeat and may be missing."""
        key, customer = F.col("o_orderkey"), F.col("o_custkey")
        ordered = F.col("o_orderdate").cast("timestamp")
        return self.table("orders").select(
            (key + 1).alias("id"),
            customer.alias("source_id"),
            text_of("<", key, "@example.com>").alias("message_id"),
            F.when(key % 13 != 0, text_of("INV-", key % 1000)).alias("invoice_number"),
            F.col("o_orderpriority").alias("vendor_name"),
            ordered.alias("due_date"),
            F.col("o_totalprice").cast("decimal(10,2)").alias("total_amount"),
            F.lit("USD").alias("currency"),
            F.when(F.col("o_orderstatus") == "F", "paid").otherwise("unpaid")
            .alias("payment_status"),
            F.array().cast(schemas.LINE_ITEMS).alias("line_items"),
            ordered.alias("created_at"),
            ordered.alias("updated_at"),
            (customer % 25).cast("string").alias("user_id"),
            F.array().cast(schemas.ATTACHED_FILES).alias("attached_files"),
            key.alias("uid"),
            (customer * 2 + 1).alias("source_folder_id"),
        )

    def tables(self) -> dict[str, DataFrame]:
        return {
            "user": self.users(),
            "source": self.sources(),
            "source_folder": self.folders(),
            "invoice": self.invoices(),
        }

    def existing_invoices(self) -> DataFrame:
        """Numbers the ledger holds already."""
        number = F.col("o_orderkey") % 1000
        return (
            self.table("orders").filter(number < 100).groupBy(number.alias("n"))
            .agg(F.lit(1))
            .select((F.col("n") + 1).alias("id"), text_of("INV-", F.col("n")).alias("invoice_number"))
        )

    # -- texts ---------------------------------------------------------------
    def emails(self) -> DataFrame:
        """Parsed emails from documents; HTML bodies where a page has the same number."""
        key = F.col("doc_id")
        pages = self.table("pages").select(F.col("page_id").alias("doc_id"), "html")
        suffix = choose(key % 3, [F.lit(" Invoice"), F.lit(" unpaid bill"), F.lit("")])
        return self.dealt("documents").join(pages, "doc_id", "left").select(
            "doc_id",
            text_of(F.col("source"), " ", F.col("lang"), suffix).alias("subject"),
            text_of(F.col("source"), "@example.com").alias("from_address"),
            F.when(key % 5 == 0, F.lit(None)).when(key % 7 == 0, F.lit(""))
            .otherwise(F.col("text")).alias("body_text"),
            F.col("html").alias("body_html"),
        )

    def classify_answers(self) -> DataFrame:
        """Model answers around a label, in every shape a model has been seen to write."""
        key, text = F.col("doc_id"), F.col("text")
        verdict = F.when(F.col("quality") == 1, "true").when(
            F.col("quality") == 0, '"no"'
        ).otherwise("null")
        answer = text_of(
            '{"is_invoice": ', verdict, ', "confidence": "high", "reasoning": "',
            F.col("lang"), '"}',
        )
        shapes = [
            answer,
            text_of("```json\n", answer, "\n```"),
            text_of("<think>", text, "</think>\n", answer),
            F.regexp_replace(answer, r"\}$", ""),
            text_of(answer, " as asked"),
            text_of(text, " ", answer, " done"),
            text_of("<think>", text, answer),
            text_of("[", answer, "]"),
            text_of("```\n", text, "\n``` ", answer),
            text_of("```JSON\n", answer, "\n```"),
        ]
        labels = self.table("labels").select("doc_id", "quality")
        suffix = choose(key % 3, [F.lit(" Invoice"), F.lit(" unpaid bill"), F.lit("")])
        return self.dealt("documents").join(labels, "doc_id", "left").select(
            "doc_id",
            text_of(F.col("source"), " ", F.col("lang"), suffix).alias("subject"),
            choose(key % 10, shapes).alias("response"),
        )

    def extract_answers(self) -> DataFrame:
        """Model answers around a line item; each invalid field occurs."""
        order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
        parts = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
        lines = lookup_join(
            self.dealt("lineitem"), parts, ["l_partkey"]
        )
        lines = staged(lines, cents=F.round(F.col("l_extendedprice") * 100).cast("bigint"))
        cents, money = F.col("cents"), F.col("money")
        lines = staged(lines, money=text_of(
            F.floor(cents / 100), ".", F.lpad((cents % 100).cast("string"), 2, "0")
        ))
        amount = choose(order % 7, [
            money, text_of('"', money, '"'), F.lit("null"), F.lit('"$12"'),
            text_of(cents * 100_000), F.lit("true"), text_of(money, "5"),
        ])
        number = F.when(order % 13 == 0, "").when(
            order % 11 == 0, text_of('"invoice_number": ', order, ", ")
        ).otherwise(text_of('"invoice_number": "INV-', order, "-", line, '", '))
        day = F.substring(F.col("l_shipdate").cast("string"), 1, 10)
        due = choose(line % 7, [
            text_of('"', day, '"'), F.lit('"null"'), F.lit("null"),
            text_of(F.unix_seconds(F.col("l_shipdate").cast("timestamp"))),
            text_of('"', day, 'T10:30:00Z"'), text_of('"', day, ' 08:15"'),
            F.lit('"Feb 3, 2024"'),
        ])
        currency = choose(
            part % 3, [F.lit(""), F.lit('"currency": null, '), F.lit('"currency": "EUR", ')]
        )
        status = choose(part % 2, [F.lit('"paid"'), F.lit("null")])
        first = text_of(
            '{"description": "', F.col("p_name"), '", "quantity": ',
            F.col("l_quantity").cast("int"), ', "unitPrice": ', money, "}",
        )
        items = F.when(F.col("l_suppkey") % 10 == 0, F.lit('"none"')).otherwise(text_of(
            "[", first,
            ', {"quantity": 1}, {"description": "tax", "quantity": "2.5", "unit_price": "1.25"}',
            ', "text", null, {"description": "fee", "unitPrice": "x"}, {"description": 7}]',
        ))
        answer = text_of(
            '{"vendor_name": "', F.col("p_name"), '", ', number, '"due_date": ', due,
            ', "total_amount": ', amount, ", ", currency, '"payment_status": ', status,
            ', "line_items": ', items, "}",
        )
        lines = staged(lines, answer=answer)
        answer = F.col("answer")
        shapes = [
            answer,
            text_of("```json\n", answer, "\n```"),
            text_of("<think>{not yet}</think> Here: ", answer, "\nAnything else?"),
        ]
        return lines.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            choose(order % 3, shapes).alias("response"),
        )

    # -- attachments ---------------------------------------------------------
    def files(self) -> DataFrame:
        """Two files per document whose names collide once the path is cut off."""
        key = F.col("doc_id")
        part = F.posexplode(F.array(
            F.struct(
                text_of("dir/", F.col("source"), ".txt").alias("filename"),
                F.col("text").alias("content"),
            ),
            F.struct(
                F.when(key % 3 == 0, text_of(F.col("source"), ".txt"))
                .when(key % 3 == 1, text_of("a\\b/", F.col("lang"), "/."))
                .otherwise(F.lit("..")).alias("filename"),
                F.col("lang").alias("content"),
            ),
        )).alias("position", "file")
        return self.table("documents").select("doc_id", part).select(
            (key % 50).alias("source_folder_id"),
            (key + 1).alias("uid"),
            "position",
            (key % 25).cast("string").alias("user_id"),
            (key % 50).alias("source_id"),
            F.lit("INBOX").alias("folder_name"),
            F.lit("7").alias("uid_validity"),
            F.col("file.filename").alias("filename"),
            F.lit("text/plain").alias("content_type"),
            F.encode("file.content", "UTF-8").alias("data"),
        )

    def stored_files(self) -> DataFrame:
        """Objects stored already: the first file of every second document."""
        return with_file_key(
            self.files().filter((F.col("position") == 0) & (F.col("uid") % 2 == 1))
        ).select(
            "file_key", "content_type", "data",
            F.octet_length("data").cast("bigint").alias("size_bytes"),
        )

    # -- raw messages --------------------------------------------------------
    def raw_documents(self) -> DataFrame:
        """RFC 822 bytes around every document: plain, HTML, both, and with files."""
        key, text = F.col("doc_id"), F.col("text")
        utf8 = F.base64(F.encode(text, "UTF-8"))
        utf16 = F.base64(F.encode(text, "UTF-16BE"))
        head = text_of(
            "Message-ID: <", key, "@example.com>\r\nSubject: ", F.col("source"), " no. ", key,
            "\r\nFrom: ", F.col("lang"), "@example.com\r\nDate: Mon, 1 Jan 2024 00:00:00 +0000\r\n",
        )
        base64_body = "\r\nContent-Transfer-Encoding: base64\r\n\r\n"
        plain = text_of("Content-Type: text/plain; charset=utf-8", base64_body, utf8)
        wide = text_of("Content-Type: text/plain; charset=utf-16-be", base64_body, utf16)
        html = text_of("Content-Type: text/html; charset=utf-8", base64_body, utf8)
        named = text_of(
            'Content-Type: text/csv\r\nContent-Disposition: attachment; filename="d',
            key, '.csv"', base64_body, F.base64(F.encode(text_of(key, ";", F.col("lang")), "UTF-8")),
        )
        open_part, close = "\r\n--b0\r\n", "\r\n--b0--\r\n"
        alternative = text_of(
            "Content-Type: multipart/alternative; boundary=b0\r\n",
            open_part, plain, open_part, html, close,
        )
        mixed = text_of(
            "Content-Type: multipart/mixed; boundary=b0\r\n",
            open_part, named, open_part, html, open_part, plain, open_part, wide, close,
        )
        body = choose(key % 5, [plain, wide, html, alternative, mixed])
        return self.dealt("documents").select(
            (key % 50).alias("source_folder_id"),
            (key + 1).alias("uid"),
            F.encode(text_of(head, "MIME-Version: 1.0\r\n", body), "UTF-8").alias("rfc822_data"),
        )

    @staticmethod
    def raw_events(events: DataFrame) -> DataFrame:
        """RFC 822 bytes around every event row, batch or stream."""
        key = F.col("event_id")
        return events.select(
            F.col("user_id").alias("source_folder_id"),
            (key + 1).alias("uid"),
            F.encode(
                text_of(
                    "Message-ID: <", key, "@example.com>\r\nSubject: ", F.col("event_type"),
                    "\r\nFrom: shop@example.com\r\nMIME-Version: 1.0\r\n"
                    "Content-Type: multipart/mixed; boundary=b0\r\n"
                    "\r\n--b0\r\nContent-Type: text/plain\r\n\r\n", F.col("props"),
                    "\r\n--b0\r\nContent-Type: text/plain\r\n"
                    'Content-Disposition: attachment; filename="props.json"\r\n\r\n',
                    F.col("props"), "\r\n--b0--\r\n",
                ),
                "UTF-8",
            ).alias("rfc822_data"),
        )

    def event_responses(self) -> DataFrame:
        """Captured model answers for every event message, both stages."""
        kind = F.col("event_type")
        verdict = F.when(kind.isin("view", "click"), "false").otherwise("true")
        cents = F.round(F.col("value") * 100).cast("bigint")
        money = text_of(F.floor(cents / 100), ".", F.lpad((cents % 100).cast("string"), 2, "0"))
        number = F.when(F.col("uid") % 10 == 0, F.lit("null")).otherwise(
            text_of('"INV-', F.col("uid") % 500, '"')
        )
        extract = (
            F.when(kind == "signup", F.lit("No invoice here."))
            .when(kind == "error", F.lit('{"total_amount": 1e9}'))
            .otherwise(text_of('{"invoice_number": ', number, ', "total_amount": ', money, "}"))
        )
        stages = F.explode(F.array(
            F.struct(F.lit("classify").alias("stage"), text_of('{"is_invoice": ', verdict, "}").alias("response")),
            F.struct(F.lit("extract").alias("stage"), extract.alias("response")),
        )).alias("s")
        return self.messages().select("source_folder_id", "uid", stages).select(
            "source_folder_id", "uid", "s.*", F.lit(None).cast("string").alias("error")
        )

    def event_folders(self) -> DataFrame:
        """The folder of every user, without marks."""
        started = ntz(START_TEXT).cast("timestamp")
        nothing = F.lit(None)
        return self._span().select(
            F.col("source_folder_id").alias("id"),
            F.col("source_folder_id").alias("source_id"),
            F.lit("INBOX").alias("folder_name"),
            F.lit("1").alias("uid_validity"),
            nothing.cast("bigint").alias("high_water_mark"),
            nothing.cast("bigint").alias("low_water_mark"),
            nothing.cast("timestamp").alias("last_processed_at"),
            started.alias("created_at"),
            started.alias("updated_at"),
        )

    def event_context(self) -> DataFrame:
        return self.event_folders().select(
            F.col("id").alias("source_folder_id"), "source_id", "folder_name", "uid_validity",
            (F.col("source_id") % 25).cast("string").alias("user_id"),
        )
