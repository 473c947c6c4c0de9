"""DuckDB SQL for the registered queries, written from the definitions, not from the Spark code."""

from __future__ import annotations

from .queries import ENTITY_NAMES, IOB_NAMES, PARTNERS, ROLE_NAMES


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def _draw(key: str) -> str:
    """60-bit draw of a text key."""
    return f"cast('0x'||substr(md5({key}),1,15) as bigint)"


def _tagged(kinds: int) -> str:
    return f"""select conv_id*1000+turn as document_id, role, string_split(text,' ') as tokens,
    list_transform(string_split(text,' '), lambda t: case when length(t)>=9 then 1+length(t)%{kinds} else 0 end) as ner_tags
    from conversations"""


PLAIN, IOB = _tagged(8), _tagged(16)
BENCH = """select item_id as document_id, string_split(text,' ') as tokens,
    list_transform(string_split(text,' '), lambda t: case when length(t)>=9 then 1+length(t)%16 else 0 end) as ner_tags
    from benchmark"""


def _split(source: str, key: str, held: str = "0.3", test: str = "0.5") -> str:
    """Exact split of a relation by shuffled rank."""
    return f"""select * exclude (r, n), case when r < ceil({test}*ceil({held}*n)) then 'test'
      when r < ceil({held}*n) then 'validation' else 'train' end as split
    from (select *, row_number() over (order by md5('42|s|'||{key}), {key})-1 as r, count(*) over () as n from ({source}))"""


def _pair_base(source: str, partners: int) -> str:
    """Pairs of a (split, label, key, text) relation: similar with the next rows, dissimilar by draws."""
    return f"""
    t as (select split, label, text, row_number() over (partition by split, label order by key)-1 as idx from ({source}) where label is not null),
    s as (select split, label, n, row_number() over (partition by split order by label)-1 as lr, count(*) over (partition by split) as nl
          from (select split, label, count(*) as n from t group by all)),
    p as (select t.split, t.label, n, lr, nl, idx as i, unnest(range(1, least({partners}, n-1)+1)) as step
          from t join s on t.split=s.split and t.label=s.label),
    z as (select *, i*least({partners}, n-1)+step-1 as q from p),
    x as (select *, (i+step)%n as j,
          {_draw("'42|d|'||label||'|'||q")} % greatest(nl-1, 1) as o0, {_draw("'42|r|'||label||'|'||q")} as pick from z),
    y as (select *, o0 + case when o0 >= lr then 1 else 0 end as o from x),
    similar_pairs as (select y.split, a.text as sentence1, b.text as sentence2, 'similar' as label from y
          join t a on a.split=y.split and a.label=y.label and a.idx=y.i
          join t b on b.split=y.split and b.label=y.label and b.idx=y.j),
    numbered as (select y.lr||'-'||y.q||'-similar' as pair, a.text as s1, b.text as s2, 1.0 as label from y
          join t a on a.split=y.split and a.label=y.label and a.idx=y.i
          join t b on b.split=y.split and b.label=y.label and b.idx=y.j
          union all select y.lr||'-'||y.q||'-dissimilar', a.text, b.text, 0.0 from y
          join t a on a.split=y.split and a.label=y.label and a.idx=y.i
          join s so on so.split=y.split and so.lr=y.o
          join t b on b.split=so.split and b.label=so.label and b.idx=y.pick%so.n),
    dissimilar_pairs as (select y.split, a.text as sentence1, b.text as sentence2, 'dissimilar' as label from y
          join t a on a.split=y.split and a.label=y.label and a.idx=y.i
          join s so on so.split=y.split and so.lr=y.o
          join t b on b.split=so.split and b.label=so.label and b.idx=y.pick%so.n)"""


_DOC_PAIRS = _pair_base("select 'all' as split, lang as label, doc_id as key, text from documents", PARTNERS)
_TURN_PAIRS = _pair_base(
    _split("select conv_id*1000+turn as key, text, role as label from conversations", "key"), PARTNERS
)


#: Embedding values with the rank of their axis by its sum of squares.
_RANKED_AXES = """e as (select vec_id, unnest(range(len(embedding))) as d, unnest(cast(embedding as double[])) as x from embeddings),
        axes as (select d, cast(row_number() over (order by sum(x*x) desc) - 1 as int) as component from e group by d),
        ranked as (select vec_id, component, x from e join axes using (d))"""


def _stripped(tag: str) -> str:
    return f"replace(replace({_list(IOB_NAMES)}[{tag}+1],'B-',''),'I-','')"


def _entities(source: str) -> str:
    """Rows with their sentence and entity list (one entry per distinct raw tag)."""
    return f"""select *, array_to_string(tokens,' ') as sentence,
      list_transform(list_filter(list_distinct(ner_tags), lambda k: k<>0), lambda k: {_stripped("k")}) as ents from ({source})"""


_SPLIT_IOB = _split(IOB, "document_id")

_TABLE_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


def _catalog() -> str:
    parts = []
    for number, (name, columns) in enumerate(_TABLE_COLUMNS.items()):
        for c in columns.split():
            label = (name, c) in {("labels", "quality"), ("labels", "toxic"), ("embeddings", "label")}
            kind = "'ClassLabel'" if label else "case when t like '%[]' then 'Sequence' else 'Value' end"
            parts.append(
                f"select {number} as pos, '{name}' as dataset, {kind} as kind from (select typeof({c}) as t from {name} limit 1)"
            )
    return " union all ".join(parts)


def _counts() -> str:
    return " union all ".join(f"select '{t}' as dataset, count(*) as n_rows from {t}" for t in _TABLE_COLUMNS)


_FITS = """
    kinds as (select pos, dataset, count(*) as n, list(distinct kind) as ks from catalog group by all),
    fits as (select a.dataset as dataset_1, b.dataset as dataset_2, a.pos as p1, b.pos as p2 from kinds a join kinds b
             on a.dataset<>b.dataset and a.n=b.n and list_has_all(b.ks, a.ks))"""


def _merged_ids(roles: list[str], names: dict[str, list[str]], order: list[str]) -> str:
    """One relation of the role datasets, tags moved to the ids of ``order``."""
    parts = []
    for number, role in enumerate(roles):
        ids = [order.index(n) for n in names[role]]
        parts.append(
            f"select {number} as part, document_id, tokens, list_transform(ner_tags, lambda k: {_list(ids)}[k+1]) as tags,"
            f" list_transform(ner_tags, lambda k: {_list(names[role])}[k+1]) as named"
            f" from ({PLAIN}) where role='{role}'"
        )
    return " union all ".join(parts)


# Ids by hand: labels of both (or all) datasets sorted, then the rest in order of appearance.
_TWO = ["O", "art", "event", "location", "person", "product", "building", "organization", "other", "place", "animal", "food"]
_THREE = ["O", "art", "event", "person", "building", "location", "organization", "other", "product", "place", "animal", "food", "law"]
_SORTED = ["O", "animal", "art", "building", "event", "food", "law", "location", "organization", "other", "person", "place", "product"]
_ROLES = list(ROLE_NAMES)


def _text(list_expr: str) -> str:
    return f"array_to_string({list_expr}, ',')"


_VECTOR_PAIRS = """select a.vec_id, cast(a.embedding as double[]) as u, cast(b.embedding as double[]) as v,
    case when a.label=b.label then 1.0 else 0.0 end as gold from embeddings a join embeddings b on b.vec_id=a.vec_id+1"""
_COSINES = f"select vec_id, list_cosine_similarity(u, v) as cosine, gold from ({_VECTOR_PAIRS})"

_NEXT = """select a.conv_id*1000+a.turn as pair_id, a.text as sentence1, b.text as sentence2,
    case when a.turn%2=0 then 'similar' else 'dissimilar' end as label
    from conversations a join conversations b on b.conv_id=a.conv_id and b.turn=a.turn+1"""

_TAG_CATALOG = f"""select distinct role as dataset, {_list(ENTITY_NAMES)}[k+1] as name from
      (select role, unnest(ner_tags) as k from ({PLAIN}) where role<>'assistant')
    union select distinct role, {_list(IOB_NAMES)}[k+1] from
      (select role, unnest(ner_tags) as k from ({IOB}) where role='assistant')"""

_CLASS_IDS = "select doc_id, text, list_position(['de','en','es','fr'], lang)-1 as label from documents"

_ROW_PAIR_SEQUENCE = f"""
    g as (select *, row_number() over (order by document_id)-1 as idx from ({_entities(BENCH)})),
    rp as (select a.idx as i, b.idx as j, a.sentence as s1, b.sentence as s2, a.ents as e1, b.ents as e2,
        len(list_filter(list_zip(a.ner_tags, b.ner_tags, true), lambda z: z[1]=z[2] and z[1]<>0))>0 as same
        from (select *, idx + unnest(range(1, {PARTNERS}+1)) as other from g) a join g b on b.idx=a.other),
    seq as (select i, j, 0 as block, s1 as sentence1, s2 as sentence2,
            case when same then 'similar' else 'not_similar' end as label from rp
        union all select i, j, 1, s1, unnest(e1), 'similar' from rp
        union all select i, j, 2, s2, unnest(e2), 'similar' from rp)"""

_FILES = """r as (select *, row_number() over (partition by dataset order by k)-1 as r from d),
        f as (select dataset, r//{0} as file_index, string_agg(value||chr(10), '' order by r) as content from r group by dataset, r//{0})"""

_ENTITY_PAIRS = f"""with g as (select *, row_number() over (partition by split order by document_id)-1 as r from ({_entities(_SPLIT_IOB)})),
        a as (select split, ents, case when r%5=0 then array_to_string(list_transform(tokens, lambda t, i:
            case when {_draw("'42|l|'||document_id||'|'||(i-1)")}%2=0 then lower(t) else t end), ' ') else sentence end as said from g),
        v as (select distinct split, unnest(ents) as e from g)
        select split, said as sentence1, unnest(ents) as sentence2, 'similar' as label from a
        union all select g.split, sentence, e, 'not_similar' from g join v on v.split=g.split where not list_contains(ents, e)"""

ORACLES: dict[str, str] = {
    "saved_dataset": f"""select doc_id, text, lang from ({_split("select doc_id, text, lang from documents", "doc_id")}) where split='validation'""",
    "merged_and_saved": f"""with m as (select row_number() over (order by part, document_id)-1 as id, len(tokens) as n
            from ({_merged_ids(_ROLES, ROLE_NAMES, _THREE)})),
        s as ({_split("select id, n as k from m", "id")})
        select split, count(*) as n_rows, sum(id) as sum_id, sum(k) as n_tokens, 'merged_dataset_1' as directory,
            'roles' as description from s group by split""",
    "scored_tsv": """select '"'||p_name as sentence1, p_brand||'\\'||p_type as sentence2, (p_size/10.0)::double/5.0 as score
        from part where p_partkey%2=0""",
    "text_chunks": """select (r//500) as file_index, r%500 as line, text as value from
        (select text, row_number() over (order by doc_id)-1 as r from documents where text is not null and text<>'')""",
    "text_files_written": f"""with d as (
          select 'documents' as dataset, doc_id as k, text as value from documents where text<>''
          union all select 'conversations', document_id, array_to_string(tokens,' ') from ({PLAIN}) where array_to_string(tokens,' ')<>''),
        {_FILES.format(100)} select dataset, file_index, length(content) as n_chars, md5(content) as digest from f""",
    "saved_text_files": f"""with d as (select 'docs' as dataset, doc_id as k, text as value
          from ({_split("select doc_id, text from documents", "doc_id")}) where split='train' and text<>''),
        {_FILES.format(50)} select dataset, file_index, md5(content) as digest from f""",
    "saved_text_pairs": f"with {_TURN_PAIRS} select * from similar_pairs union all select * from dissimilar_pairs",
    "saved_entity_pairs": _ENTITY_PAIRS,
    "split_text_class": f"""with c as ({_CLASS_IDS}) select 1 as part, doc_id, label from c where label in (0,1)
        union all select 2, doc_id, label from c where label in (1,2)""",
    "split_token_tags": f"""with c as ({PLAIN}) select 1 as part, document_id, {_text("ner_tags")} as tags from c where list_has_any(ner_tags,[1,2])
        union all select 2, document_id, {_text("ner_tags")} from c where list_has_any(ner_tags,[3,4])""",
    "split_token_tags_exclusive": f"""with c as (select *, list_has_any(ner_tags,[1,2]) as a, list_has_any(ner_tags,[3,4]) as b from ({IOB}))
        select case when a then 1 else 2 end as part, document_id, {_text("ner_tags")} as tags from c where a<>b""",
    "task_detection": f"""with c as ({_CLASS_IDS}), d as ({PLAIN})
        select 'documents' as dataset, 'text-class' as task, 1 as part, count(*) as n_rows from c where label=1
        union all select 'documents', 'text-class', 2, count(*) from c where label=2
        union all select 'conversations', 'token-tag', 1, count(*) from d where list_contains(ner_tags,1)
        union all select 'conversations', 'token-tag', 2, count(*) from d where list_contains(ner_tags,2)""",
    "text_columns": f"""select 'documents' as dataset, 'text' as column_name, count(text) as n_rows, sum(length(text)) as n_chars from documents
        union all select 'pages', 'url', count(url), sum(length(url)) from pages
        union all select 'conversations', 'tokens', count(*), sum(length(array_to_string(tokens,' '))) from ({PLAIN})
        union all select 'events', 'event_type', count(event_type), sum(length(event_type)) from events""",
    "non_empty_text": "select doc_id, text from documents where lang in ('en','de') and text<>''",
    "rows_per_label": "select source, lang as label, count(*) as n_examples from documents where lang is not null group by all",
    "training_examples": f"""select pair_id, sentence1||' || '||sentence2 as texts,
        case when label='similar' then 1.0::double else 0.0::double end as label from ({_NEXT})""",
    "declared_schema": f"select doc_id as document_id, label, text from ({_CLASS_IDS})",
    "updated_tags": f"""select 'strings' as given, document_id, {_text("list_transform(ner_tags, lambda k: 8-k)")} as tags from ({PLAIN})
        union all select 'ids', document_id, {_text("ner_tags")} from ({PLAIN})""",
    "pair_plan": f"""with t as ({_split("select conv_id*1000+turn as key, role as label from conversations", "key")}),
        s as (select split, label, count(*) as n from t where label is not null group by all)
        select split, label, n as n_examples, count(*) over (partition by split) as n_labels, n*least({PARTNERS}, n-1) as num_pairs,
          n*least({PARTNERS}, n-1) as generated, case when n > 1 then n else 0 end as firsts from s""",
    "similar_pairs": f"with {_DOC_PAIRS} select sentence1, sentence2, label from similar_pairs",
    "dissimilar_pairs": f"with {_DOC_PAIRS} select sentence1, sentence2, label from dissimilar_pairs",
    "text_pairs_by_split": f"with {_TURN_PAIRS} select * from similar_pairs union all select * from dissimilar_pairs",
    "similar_entity_pairs": f"select sentence as sentence1, unnest(ents) as sentence2, 'similar' as label from ({_entities(IOB)})",
    "dissimilar_entity_pairs": f"""with g as ({_entities(IOB)}), v as (select distinct unnest(ents) as e from g)
        select sentence as sentence1, e as sentence2, 'not_similar' as label from g, v where not list_contains(ents, e)""",
    "entity_pairs_by_split": _ENTITY_PAIRS,
    "row_pairs": f"""with g as (select *, row_number() over (order by document_id)-1 as idx from ({PLAIN})),
        f as (select *, idx + unnest(range(1, {PARTNERS}+1)) as other from g)
        select array_to_string(a.tokens,' ') as sentence1, array_to_string(b.tokens,' ') as sentence2,
          case when len(list_filter(list_zip(a.ner_tags, b.ner_tags, true), lambda z: z[1]=z[2] and z[1]<>0))>0
            then 'similar' else 'not_similar' end as label
        from f a join g b on b.idx=a.other""",
    "row_pair_entities": f"""with g as (select document_id, array_to_string(tokens,' ') as s, list_filter(list_distinct(ner_tags), lambda k: k<>0) as ids from ({IOB})),
        e as (select a.document_id, a.s, unnest(a.ids) as k from g a join g b on a.document_id<>b.document_id)
        select document_id, s as sentence1, {_stripped("k")} as sentence2, 'similar' as label, count(*) as n_copies
        from e group by document_id, s, k""",
    "row_pairs_with_entities": f"with {_ROW_PAIR_SEQUENCE} select i, j, block, sentence1, sentence2, label from seq",
    "dissimilar_from_pairs": f"""with p as (select *, row_number() over (order by pair_id)-1 as k from ({_NEXT})),
        f as (select *, k + unnest(range(1, {PARTNERS}+1)) as other from p)
        select a.sentence1, b.sentence2, 'not_similar' as label from f a join p b on b.k=a.other
        where not (a.label='similar' and b.label='similar')""",
    "all_row_pairs": f"""with {_ROW_PAIR_SEQUENCE},
        o as (select *, row_number() over (order by i, j, block, sentence2)-1 as k from seq),
        f as (select *, k + unnest(range(1, {PARTNERS}+1)) as other from o)
        select sentence1, sentence2, label from seq
        union all select a.sentence1, b.sentence2, 'not_similar' from f a join o b on b.k=a.other
        where not (a.label='similar' and b.label='similar')""",
    "dissimilar_pair_counts": f"""with p as (select *, row_number() over (order by pair_id)-1 as k from ({_NEXT})),
        m as (select a.sentence1, b.sentence2 from p a join p b on b.k>a.k where not (a.label='similar' and b.label='similar'))
        select 'first' as side, sentence1 as sentence, count(*) as n_pairs from m group by sentence1
        union all select 'second', sentence2, count(*) from m group by sentence2""",
    "random_dissimilar_pairs": f"""with g as (select *, array_to_string(list_sort(list_filter(list_distinct(ner_tags), lambda t: t<>0)), ',') as s,
            list_filter(ner_tags, lambda t: t<>0) as ts from ({PLAIN})),
        h as (select *, row_number() over (partition by s order by document_id)-1 as idx from g),
        sets as (select s, any_value(ts) as ts, count(*) as n, row_number() over (order by s)-1 as rank from g group by s),
        apart as (select a.rank as a, b.rank as b, a.n as na, b.n - (case when a.rank=b.rank then 1 else 0 end) as nb
          from sets a join sets b on not list_has_any(a.ts, b.ts)),
        apart2 as (select *, sum(nb) over (partition by a order by b) - nb as before from apart),
        w as (select a, any_value(na) as na, any_value(na)*sum(nb) as w from apart group by a),
        starts as (select *, sum(w) over (order by a) - w as start, sum(w) over () as total from w),
        d as (select c, (cast({_draw("'42|p|'||c")} as hugeint)*(select max(total) from starts))//(cast(1 as hugeint)<<60) as x from (select unnest(range(1000)) as c)),
        e as (select c, a, (x-start)//na as q, (x-start)%na as i from d join starts on x>=start and x<start+w),
        f as (select c, e.a, e.i, b, q-before as j0 from e join apart2 t on t.a=e.a and q>=before and q<before+nb),
        k as (select c, a, i, b, case when a=b and j0>=i then j0+1 else j0 end as j from f)
        select array_to_string(l.tokens,' ') as sentence1, array_to_string(r.tokens,' ') as sentence2, 'not_similar' as label from k
          join sets sa on sa.rank=k.a join h l on l.s=sa.s and l.idx=k.i join sets sb on sb.rank=k.b join h r on r.s=sb.s and r.idx=k.j""",
    "remapped_tags": f"""select {_list(_ROLES)}[part+1] as role, document_id, {_text("tags")} as tags from ({_merged_ids(_ROLES, ROLE_NAMES, _THREE)})""",
    "entity_vocabulary": f"select distinct role, unnest(ents) as entity from ({_entities(IOB)})",
    "common_labels": """select lang as name from documents where lang is not null group by lang
        having count(distinct source) = (select count(distinct source) from documents)""",
    "label_union": "select row_number() over (order by name)-1 as id, name from (select distinct lang as name from documents where lang is not null)",
    "distinct_sentences": f"select sentence1 as sentence from ({_NEXT}) union select sentence2 from ({_NEXT})",
    "row_counts": _counts(),
    "label_inventory": """select concat_ws('-', source, lang) as label, count(distinct source) as n_models, count(*) as n_ids,
        (select count(distinct concat_ws('-', source, lang)) from documents) as n_labels from documents group by concat_ws('-', source, lang)""",
    "sorted_and_renumbered": f"""select row_number() over (order by part, document_id)-1 as document_id, array_to_string(tokens,' ') as sentence
        from ({_merged_ids(_ROLES, ROLE_NAMES, _THREE)})""",
    "split_70_15_15": _split("select doc_id, lang from documents", "doc_id"),
    "split_80_10_10": _split("select doc_id, lang from documents", "doc_id", "0.2"),
    "random_examples": "select doc_id, text from documents order by md5('42|s|'||doc_id), doc_id limit 20",
    "shuffled_sample": "select o_orderkey, o_custkey from orders order by md5('42|s|'||o_orderkey), o_orderkey limit 10000",
    "sampled_sentences": f"""select sentence from (select sentence1 as sentence from ({_NEXT}) union select sentence2 from ({_NEXT}))
        order by md5('42|s|'||sentence), sentence limit 300""",
    "sampled_training_examples": f"""with {_DOC_PAIRS} select pair, s1||' || '||s2 as texts, label::double as label from numbered
        order by md5('42|s|'||pair), pair limit 20""",
    "shuffled_batches": """select doc_id, lang, r//32 as batch_id, r%32 as batch_pos from
        (select doc_id, lang, row_number() over (order by md5('42|s|'||doc_id), doc_id)-1 as r from documents)""",
    "every_fifth_row": "select doc_id, lang, (row_number() over (partition by lang order by doc_id)-1)%5=0 as flagged from documents",
    "concatenated": f"select document_id, array_to_string(tokens,' ') as sentence from ({PLAIN})",
    "merged_two": f"""select row_number() over (order by part, document_id)-1 as document_id, array_to_string(tokens,' ') as sentence,
        {_text("tags")} as tags from ({_merged_ids(["user", "assistant"], ROLE_NAMES, _TWO)})""",
    "merged_three": f"""select row_number() over (order by part, document_id)-1 as document_id, array_to_string(tokens,' ') as sentence,
        {_text("named")} as tags from ({_merged_ids(_ROLES, ROLE_NAMES, _THREE)})""",
    "merged_strict": f"""select document_id, array_to_string(tokens,' ') as sentence, {_text("tags")} as tags
        from ({_merged_ids(_ROLES, ROLE_NAMES, _SORTED)})""",
    "merged_strict_keep_ids": f"""select document_id, array_to_string(tokens,' ') as sentence,
        {_text("list_transform(ner_tags, lambda k: " + _list(_SORTED) + "[k+1])")} as tags from ({PLAIN})""",
    "compatible_tables": f"""with catalog as ({_catalog()}), counts as ({_counts()}), {_FITS}
        select dataset_1, dataset_2, a.n_rows+b.n_rows as n_rows from fits
        join counts a on a.dataset=dataset_1 join counts b on b.dataset=dataset_2""",
    "mergeable_groups": f"""with recursive catalog as ({_catalog()}), counts as ({_counts()}), {_FITS},
        later as (select k.pos as p, coalesce(list(f.p2 order by f.p2) filter (f.p2 is not null), []) as l
            from kinds k left join fits f on f.p1=k.pos and f.p2>k.pos group by k.pos),
        walk as (select -1 as p, []::integer[] as seen, false as opens union all
            select l.p, case when list_contains(w.seen, l.p) then w.seen else list_concat(w.seen, l.l) end, not list_contains(w.seen, l.p)
            from walk w join later l on l.p=w.p+1),
        opened as (select row_number() over (order by w.p) as group_id, list_concat([w.p], l.l) as ps
            from walk w join later l on l.p=w.p where w.opens),
        member as (select group_id, unnest(ps) as p from opened)
        select cast(group_id as integer) as group_id, string_agg(k.dataset, ',' order by m.p) as datasets, cast(sum(c.n_rows) as bigint) as n_rows
        from member m join kinds k on k.pos=m.p join counts c on c.dataset=k.dataset group by group_id""",
    "wanted_tags": f"""select document_id, {_text("list_sort(list_intersect(list_distinct(ner_tags), [1,2,3,4]))")} as tags from ({PLAIN})""",
    "sentences": f"select document_id, array_to_string(tokens,' ') as sentence from ({PLAIN})",
    "lowercased_tokens": f"""select document_id, array_to_string(list_transform(tokens, lambda t, i:
        case when {_draw("'42|l|'||document_id||'|'||(i-1)")}%2=0 then lower(t) else t end), ' ') as sentence from ({PLAIN})""",
    "stripped_names": f"select dataset, name, replace(replace(name,'B-',''),'I-','') as entity from ({_TAG_CATALOG})",
    "iob_check": f"select dataset, bool_and(name like 'B-%' or name like 'I-%' or name='O') as is_iob from ({_TAG_CATALOG}) group by dataset",
    "iob_names": f"""with t as ({_TAG_CATALOG}), a as (select row_number() over (order by name)-1 as id, name from (select distinct name from t)),
        b as (select row_number() over (order by name)-1 as id, name from (select distinct name from t where dataset='assistant'))
        select 'all' as of, id, case when name='O' then 'O' else 'B-'||name end as iob_name from a
        union all select 'assistant', id, name from b""",
    "label_map": """select id, name, (select count(*) from documents where lang=name) as n_rows
        from (select unnest(range(4)) as id, unnest(['de','en','es','fr']) as name)""",
    "named_tags": f"select document_id, array_to_string(list_transform(ner_tags, lambda k: {_list(IOB_NAMES)}[k+1]), ' ') as tags from ({IOB})",
    "label_ids": f"select doc_id, label from ({_CLASS_IDS})",
    "distinct_tags": f"""select document_id, {_text("list_sort(list_transform(list_filter(list_distinct(ner_tags), lambda k: k<>0), lambda k: " + _list(ENTITY_NAMES) + "[k+1]))")} as tags from ({PLAIN})""",
    "same_position_tags": f"""with g as ({PLAIN}) select a.document_id,
        len(list_filter(list_zip(a.ner_tags, b.ner_tags, true), lambda z: z[1]=z[2] and z[1]<>0))>0 as same
        from g a join g b on b.document_id=a.document_id+1""",
    "rescaled_scores": "select p_partkey, round(p_size/5.0, 6)::double as score from part",
    "cosine_of_pairs": f"select vec_id, round(cosine, 6) as cosine, gold::double as gold from ({_COSINES})",
    "similarity_pearson": f"select round(corr(cosine, gold), 6) as pearson from ({_COSINES})",
    "similarity_spearman": f"""select round(corr(ra, rb), 6) as spearman from (select
        rank() over (order by cosine) + (count(*) over (partition by cosine)-1)/2.0 as ra,
        rank() over (order by gold) + (count(*) over (partition by gold)-1)/2.0 as rb from ({_COSINES}))""",
    "cosine_loss": f"select round(avg(power(cosine-gold, 2)), 6) as loss from ({_COSINES})",
    "pca_fit": """with e as (select vec_id, unnest(range(len(embedding))) as d, unnest(cast(embedding as double[])) as x from embeddings),
        c as (select a.d as i, b.d as j, covar_samp(a.x, b.x) as v from e a join e b using (vec_id) group by a.d, b.d)
        select count(*) filter (i=j) as n_components, round(sum(v) filter (i=j), 4) as total_variance,
          round(sum(v*v), 5) as squared_variances from c""",
    "pca_projection": f"""with {_RANKED_AXES} select vec_id, component, round(abs(x), 5) as length from ranked where component < 16""",
    "dimension_sweep": f"""with {_RANKED_AXES},
        cut as (select vec_id, k, list(x order by component) as v from ranked, (select unnest([48, 32, 16]) as k) where component < k group by vec_id, k)
        select k, round(corr(list_cosine_similarity(a.v, b.v), (la.label=lb.label)::int), 5) as score
        from cut a join cut b using (k) join embeddings la on la.vec_id=a.vec_id join embeddings lb on lb.vec_id=b.vec_id
        where b.vec_id=a.vec_id+1 group by k""",
    "pca_projection_norms": """select vec_id, round(sqrt(list_dot_product(cast(embedding as double[]), cast(embedding as double[]))), 4) as norm from embeddings""",
    "dimension_sweep_full": f"""select (select max(len(embedding)) from embeddings) as k, round(corr(cosine, gold), 4) as score from ({_COSINES})""",
    "encoded_sentences": """select doc_id, length(text)-length(replace(text,'a','')) as e0, length(text)-length(replace(text,'e','')) as e1,
        length(text)-length(replace(text,' ','')) as e2 from documents""",
}

ORACLES["wide_pca_fit"] = ORACLES["pca_fit"]

# Integer widths as the queries return them.
_WIDTHS = {
    "merged_and_saved": {"sum_id": "bigint", "n_tokens": "bigint"},
    "text_chunks": {"line": "integer"},
    "text_files_written": {"n_chars": "integer"},
    "text_columns": {"n_chars": "bigint"},
    "declared_schema": {"document_id": "integer"},
    "shuffled_batches": {"batch_pos": "integer"},
    "label_map": {"id": "integer"},
    "dimension_sweep_full": {"k": "integer"},
}
for _name, _columns in _WIDTHS.items():
    _casts = ", ".join(f"cast({c} as {t}) as {c}" for c, t in _columns.items())
    ORACLES[_name] = f"select * replace ({_casts}) from ({ORACLES[_name]})"
