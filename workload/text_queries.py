"""Notes and entities."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casegraph.functions import text as tx
from casegraph.operators import entities as en
from casegraph.session import new_folder
from casegraph.sources.readers import scan_csv
from casegraph.sources.sinks import write_table
from workload.registry import joined, query
from workload.tables import CTES, Tables, with_ctes

_LISTS = ("symptoms", "diseases", "medications")


def _shown(sets):
    return sets.select("hadm_id", *[joined(F.col(c)).alias(c) for c in _LISTS])


_SHOWN_SQL = "SELECT hadm_id, " + ", ".join(f"array_to_string({c}, '|') AS {c}" for c in _LISTS) + " FROM "


@query(
    "notes_selected",
    with_ctes("adm", "SELECT doc_id AS hadm_id, md5(text) AS text_md5 FROM documents WHERE text IS NOT NULL AND doc_id IN (SELECT hadm_id FROM adm)"),
)
def _(t: Tables):
    return en.select_notes(t.notes, t.admissions).select("hadm_id", F.md5("text").alias("text_md5"))


# an empty cell means a missing value
@query("csv_notes", "SELECT doc_id, nullif(lang, '') AS lang, md5(nullif(text, '')) AS text_md5 FROM documents")
def _(t: Tables):
    folder = new_folder(t.spark, "csv-notes")
    write_table(t.scan("documents", "doc_id", "text", "lang"), folder, "csv")
    notes = scan_csv(t.spark, folder, StructType.fromDDL("lang string, doc_id long, text string"), multi_line=True)
    return notes.select("doc_id", "lang", F.md5("text").alias("text_md5"))


@query(
    "first_words",
    r"""SELECT doc_id, array_to_string(list_slice(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''), 1, 350), ' ')
        AS note_window FROM documents""",
)
def _(t: Tables):
    return t.scan("documents", "doc_id", "text").select("doc_id", tx.first_words(F.col("text")).alias("note_window"))


@query("entity_mentions", with_ctes("mention", "SELECT * FROM mention"))
def _(t: Tables):
    return t.mentions


@query("entity_sets", with_ctes("sets", _SHOWN_SQL + "sets"))
def _(t: Tables):
    return _shown(t.entity_sets)


@query("entity_clean", with_ctes("clean_sets", _SHOWN_SQL + "clean_sets"))
def _(t: Tables):
    return _shown(t.entities)


@query(
    "entity_counts",
    with_ctes(
        "clean_sets",
        "SELECT hadm_id, " + ", ".join(f"len({c})::BIGINT AS n_nlp_{c}" for c in _LISTS) + " FROM clean_sets",
    ),
)
def _(t: Tables):
    return t.entity_counts


@query(
    "entity_merge",
    with_ctes(
        "mention",
        _SHOWN_SQL + "merged",
        c_tok=r"""SELECT conv_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS ws
                  FROM conversations""",
        c_gram="""SELECT conv_id, unnest(ws) AS term FROM c_tok UNION ALL
                  SELECT conv_id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM c_tok UNION ALL
                  SELECT conv_id, unnest(flatten(list_transform(range(1, len(ws)), lambda i:
                    [array_to_string(ws[i:i + n], ' ') FOR n IN [2, 3, 4] IF i + n <= len(ws)]))) FROM c_tok""",
        found="""SELECT hadm_id, term, kind FROM mention UNION SELECT conv_id, term, kind FROM c_gram JOIN dict USING (term)""",
        merged=CTES["mention_sets"][1].replace("FROM mention", "FROM found"),
    ),
)
def _(t: Tables):
    talks = t.scan("conversations", "conv_id", "text").toDF("hadm_id", "text")
    later = en.entity_sets(en.dictionary_mentions(talks, t.dictionary))
    return _shown(en.merge_entity_sets(en.entity_sets(t.mentions), later))


_EVENT_KINDS = {"click": "symptom", "view": "disease", "error": "medication"}


@query(
    "entity_kinds",
    "SELECT event_id, CASE event_type " + " ".join(f"WHEN '{g}' THEN '{k}'" for g, k in _EVENT_KINDS.items())
    + " END AS kind FROM events WHERE event_type IN (" + ", ".join(f"'{g}'" for g in _EVENT_KINDS) + ")",
)
def _(t: Tables):
    rows = t.scan("events", "event_id", "event_type")
    return en.route_mentions(rows, "event_type", _EVENT_KINDS).select("event_id", "kind")


@query(
    "tag_normalize",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag AS label FROM lineitem""",
)
def _(t: Tables):
    tag = F.concat(F.when(F.col("l_linestatus") == "O", "B-").otherwise("I-"), F.col("l_returnflag"))
    return t.scan("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus").select(
        "l_orderkey", "l_linenumber", "l_partkey", tx.strip_tag(tag).alias("label")
    )


@query(
    "label_resolve",
    """SELECT CASE WHEN bool_or(c_mktsegment = 'Medication') THEN 'Medication' WHEN bool_or(c_mktsegment = 'MACHINERY')
       THEN 'MACHINERY' WHEN bool_or(c_mktsegment = 'HOUSEHOLD') THEN 'HOUSEHOLD' END AS label FROM customer""",
)
def _(t: Tables):
    return en.resolve_label(t.scan("customer", "c_mktsegment"), "c_mktsegment", ["Medication", "MACHINERY", "HOUSEHOLD"])


@query(
    "notes_pending",
    "SELECT doc_id AS hadm_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def _(t: Tables):
    notes = t.scan("documents", "doc_id", "text", "n_chars").withColumnRenamed("doc_id", "hadm_id")
    done = t.scan("labels", "doc_id").withColumnRenamed("doc_id", "hadm_id")
    return en.pending_notes(notes, done).select("hadm_id", "n_chars")


def _load_tagger():
    """A stand-in for a model: it tags one word, and fails on texts with a certain mark."""

    def tag(texts):
        found = []
        for text in texts:
            if "###" in text:
                raise ValueError("cannot read ###")
            found.append([{"entity_group": "Sign_symptom", "word": w} for w in text.split() if w == "the"])
        return found

    return tag


@query(
    "extract_report",
    """WITH pending AS (SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
       SELECT 'processed' AS metric, count(*) AS value FROM pending
       UNION ALL SELECT 'failed', count(*) FROM pending WHERE contains(text, '###')
       UNION ALL SELECT 'enriched', count(DISTINCT doc_id) FROM pending WHERE NOT contains(text, '###')
       UNION ALL SELECT 'skipped', count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)""",
)
def _(t: Tables):
    done = t.scan("labels", "doc_id").withColumnRenamed("doc_id", "hadm_id")
    extracted = en.model_mentions(en.pending_notes(t.notes, done), _load_tagger)
    return en.extraction_report(extracted, t.notes.select("hadm_id"), done)
