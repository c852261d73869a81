"""SQL twins of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

import json

from corpusloom.functions.vectors import CLIP_DIM, TEXT_DIM
from corpusloom.operators.versions import MODELS
from corpusloom.plans.inputs import AUDIO, CLIPS, FRAMES, IMAGES, VIDEOS
from corpusloom.plans.registry import NEAR
from corpusloom.schemas import MODALITIES
from corpusloom.sources import connectors as con
from corpusloom.sources.probe import PRESETS
from corpusloom.sources.scan import IMAGE_SAMPLE_SOURCE, TEXT_SAMPLE_SOURCE


def _norm(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def _words(x: str) -> str:
    return f"(case when {x} = '' then 0 else len(string_split({x}, ' ')) end)"


def _letters(x: str) -> str:
    return rf"length(regexp_replace({x}, '[^\p{{L}}]+', '', 'g'))"


def _text_reason(raw: str) -> str:
    return f"""concat_ws('|',
        case when {_words(_norm(raw))} < 10 then 'too_short' end,
        case when length({raw}) > 0 and {_letters(raw)} / length({raw}) < 0.5
             then 'low_alpha_ratio' end)"""


STATUS = "case when quality_reason = '' then 'pass' else 'fail' end"

# The manifests. `ex` says whether the asset file is in the listing.
M_TEXT = f"""t_raw as (
    select doc_id as idx, {_norm('text')} as content, n_chars::int as token_count from documents),
m_text as (
    select printf('fineweb_%08d', idx) as id, '{con.TEXT_SOURCE}' as source, 'text' as modality,
        sha256(content) as content_hash, content, substr(content, 1, 200) as caption, idx,
        0 as sub_idx, token_count, false as ex, '' as ext
    from t_raw where {_words('content')} >= 30)"""

M_IMAGE = f"""i_raw as (
    select page_id as idx, html, url,
        list_filter([trim(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)),
                     trim(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1))], lambda x: x <> '') as caps
    from pages),
m_image as (
    select printf('coco_%012d', idx) as id, '{con.IMAGE_SOURCE}' as source, 'image' as modality,
        sha256(html) as content_hash, '{IMAGES}/' || printf('coco_%012d', idx) || '.jpg' as content,
        caps[1] as caption, idx, 0 as sub_idx, caps, regexp_extract(url, '([^/]*)$', 1) as filename,
        not contains(url, '#') as ex, '.jpg' as ext
    from i_raw where len(caps) > 0)"""

M_CLIP = f"""c_raw as (
    select p_partkey as idx, p_size::double as dur, p_type, p_brand,
        {_norm("case when p_type <> 'PROMO' and p_name <> '' then p_name else p_brand end")} as caption,
        unnest(range(greatest(1, ceil(p_size / 8.0)::int))) as clip_idx
    from part where p_size < 50),
c_ids as (
    select *, printf('finevideo_%08d_clip_%03d', idx, clip_idx) as id,
        ceil(floor(least(8.0, dur - clip_idx * 8.0) * 24.0) / 24)::int as n_keyframes
    from c_raw where caption <> ''),
m_video as (
    select id, '{con.CLIP_SOURCE}' as source, 'video' as modality,
        sha256(id || caption) as content_hash, '{CLIPS}/' || id || '.mp4' as content, caption, idx,
        clip_idx::int as sub_idx, n_keyframes, dur, p_type, p_brand, dur > 3 as ex, '.mp4' as ext
    from c_ids where n_keyframes > 0)"""

M_AUDIO = f"""a_raw as (
    select row_number() over (order by conv_id, turn) - 1 as idx, conv_id, turn, role, text,
        {_norm('text')} as caption from conversations),
m_audio as (
    select printf('librispeech_%08d', idx) as id, '{con.AUDIO_SOURCE}' as source,
        'audio' as modality, sha256(text) as content_hash,
        '{AUDIO}/' || printf('librispeech_%08d', idx) || '.wav' as content, caption, idx,
        0 as sub_idx, conv_id, turn, true as ex, '.wav' as ext
    from a_raw where caption <> '' and role <> 'system')"""

_COLS = "id, source, modality, content_hash, content, caption, idx, sub_idx, ex, ext"
MAN = f"""{M_TEXT}, {M_IMAGE}, {M_CLIP}, {M_AUDIO},
man as (
    select {_COLS}, null::int as n_keyframes from m_text
    union all select {_COLS}, null from m_image
    union all select {_COLS}, n_keyframes from m_video
    union all select {_COLS}, null from m_audio)"""

LICENSE = """case
    when contains(lower(source), 'fineweb-edu') then 'mit'
    when contains(lower(source), 'coco') then 'cc-by-4.0'
    when contains(lower(source), 'finevideo') then 'cc-by-4.0'
    when contains(lower(source), 'huggingfacefv') then 'cc-by-4.0'
    when contains(lower(source), 'msr-vtt') then 'research-only'
    when contains(lower(source), 'msrvtt') then 'research-only'
    when contains(lower(source), 'librispeech') then 'cc-by-4.0'
    when contains(lower(source), 'openslr') then 'cc-by-4.0'
    else 'unknown' end"""

GATED = f"""{MAN},
reasoned as (
    select *, case modality
        when 'text' then {_text_reason('content')}
        when 'image' then concat_ws('|',
            case when not ex then 'missing_file' end,
            case when ex and not length(caption) > 20 then 'corrupt_image' end,
            case when ex and {_norm('caption')} = '' then 'empty_caption' end)
        when 'video' then concat_ws('|',
            case when not ex then 'missing_file' end,
            case when n_keyframes = 0 then 'no_keyframes' end)
        else concat_ws('|',
            case when length(caption) % 97 <> 0 and (length(caption) % 40) / 1000 < 0.01
                 then 'silent_audio' end,
            case when length(caption) % 97 <> 0 and length(caption) / 100 < 0.5
                 then 'too_short' end,
            case when length(caption) % 97 = 0 then 'corrupt_audio' end)
        end as quality_reason
    from man),
gated as (select *, {STATUS} as quality_status, {LICENSE} as license from reasoned)"""

MOD_ORDER = "list_position(['text', 'image', 'video', 'audio'], modality)"

_BUCKET = "('0x' || substr(md5(w), 1, 8))::bigint"
_SIGN = "case when ('0x' || substr(md5(w), 9, 1))::int < 8 then 1 else -1 end"


def _vectors(tokens: str, name: str = "vec") -> str:
    """Sparse vectors `id, b, val` (b from 0) of `id, dim, w` token rows."""
    return f"""{name}_tok as ({tokens}),
{name}_cnt as (
    select id, {_BUCKET} % dim as b, sum({_SIGN})::double as s from {name}_tok
    where w <> '' group by 1, 2),
{name}_len as (select id, sqrt(sum(s * s)) as n from {name}_cnt group by id),
{name} as materialized (
    select id, b, (s / n)::float::double as val
    from {name}_cnt join {name}_len using (id) where n > 0)"""


def _tokens(table: str, column: str, dim: int, id_col: str = "id") -> str:
    return f"""select {id_col} as id, {dim} as dim, unnest(string_split({_norm(column)}, ' ')) as w
        from {table}"""


def _sum_check(name: str) -> str:
    return f"select id, round(sum(val * (b + 1)), 4) as vec_checksum from {name} group by id"


V_TEXT = _vectors(_tokens("m_text", "content", TEXT_DIM), "v_text")
V_IMAGE = _vectors(_tokens("m_image", "caption", CLIP_DIM), "v_image")
V_AUDIO = _vectors(_tokens("m_audio", "caption", TEXT_DIM), "v_audio")
# Every frame path is one word, so a frame's vector has one component; a clip
# is the mean of its frames.
V_VIDEO = f"""v_video_tok as (
    select id, n_keyframes, '{FRAMES}/' || id || printf('/frame_%03d.jpg', unnest(range(1, n_keyframes + 1))) as w
    from m_video),
v_video as materialized (
    select id, {_BUCKET} % {CLIP_DIM} as b, (sum({_SIGN}) / any_value(n_keyframes))::float::double as val
    from v_video_tok group by 1, 2)"""
V_ALL = f"""{V_TEXT}, {V_IMAGE}, {V_VIDEO}, {V_AUDIO},
v_all as materialized (
    select 'text' as modality, * from v_text union all select 'image', * from v_image
    union all select 'video', * from v_video union all select 'audio', * from v_audio)"""


def _greedy(pairs: str, order: str) -> str:
    """`kept(pos)`: first-kept greedy choice over `pairs(i, j)`, i before j."""
    return f"""pairs as materialized ({pairs}),
nbrs as materialized (select j, list(i) as before from pairs group by j),
steps as materialized (
    select pos, row_number() over (order by pos) as rn, before
    from ({order}) left join nbrs on j = pos),
walk(rn, kept) as (
    select 0::bigint, []::bigint[]
    union all
    select s.rn, case when s.before is not null and list_has_any(w.kept, s.before)
                      then w.kept else list_append(w.kept, s.pos) end
    from walk w join steps s on s.rn = w.rn + 1),
kept as materialized (
    select unnest(kept) as pos from walk where rn = (select max(rn) from walk))"""


STORED = f"""emb as materialized (
    select vec_id as pos, label, embedding::double[] as v,
        sqrt(list_inner_product(embedding::double[], embedding::double[])) as n from embeddings),
{_greedy(f'''select a.pos as i, b.pos as j from emb a join emb b on a.pos < b.pos
    where list_inner_product(a.v, b.v) / (a.n * b.n) > {NEAR}''', 'select pos from emb')}"""

# Texts that pass the gate, first of each hash, greedy at 0.92.
CURATED = f"""{M_TEXT},
uniq as materialized (
    select * from m_text where {_text_reason('content')} = ''
    qualify row_number() over (partition by content_hash order by idx) = 1),
{_vectors(_tokens('uniq', 'content', TEXT_DIM, 'idx'), 'uv')},
ulen as (select id, sqrt(sum(val * val)) as n from uv group by id),
{_greedy('''select a.id as i, b.id as j from uv a join uv b on a.b = b.b and a.id < b.id
    join ulen x on x.id = a.id join ulen y on y.id = b.id
    group by a.id, b.id, x.n, y.n having sum(a.val * b.val) / (x.n * y.n) > 0.92''',
    'select idx as pos from uniq')}"""

_FLAT = "id, source, modality, content_hash, content, caption"


def _top(dist: str, keys: str, k: int = 5) -> str:
    return f"row_number() over (partition by {keys} order by {dist}, id) as rank"


CENTROIDS = """comp as (
    select vec_id as id, label, unnest(embedding)::double as x,
        generate_subscripts(embedding, 1) as i from embeddings),
cent as materialized (
    select label as query_id, i, avg(x) as m from comp group by label, i)"""

PROBES = f"""{_vectors(_tokens('benchmark', 'text', TEXT_DIM, 'item_id'), 'qt')},
{_vectors(_tokens('benchmark', 'text', CLIP_DIM, 'item_id'), 'qc')}"""


def _sparse_search(rows: str, queries: str, extra: str = "") -> str:
    """`hits(query_id, {extra} id, distance)`; `rows(grp…, id, b, val)`."""
    return f"""r2 as (select id, sum(val * val) as n2 from {rows} group by id),
q2 as (select id as query_id, sum(val * val) as n2 from {queries} group by id),
dots as (
    select q.id as query_id, r.id, sum(q.val * r.val) as dot
    from {queries} q join {rows} r on q.b = r.b group by 1, 2),
hits as materialized (
    select q2.query_id, r2.id,
        round(greatest(q2.n2 + r2.n2 - 2 * coalesce(dot, 0), 0), 9) as d
    from q2 cross join r2 left join dots on dots.query_id = q2.query_id and dots.id = r2.id)"""


VERSION = f"""{GATED},
vi as (
    select 'v001' as version, id, modality, source, content_hash,
        row_number() over (order by {MOD_ORDER}, id) - 1 as pos
    from gated where quality_status = 'pass')"""

TWO = f"""{GATED},
va as (select id, modality, content_hash from gated where modality in ('text', 'image')),
vb as (select id, modality, content_hash from gated where quality_status = 'pass')"""

PLAN = f"""{GATED},
vi as (select *, row_number() over (order by {MOD_ORDER}, id) - 1 as pos from gated),
members as (select *, pos // 100 as shard_idx from vi where quality_status = 'pass')"""

CAS = f"""{MAN},
lay as (
    select id, modality, content_hash, content as src, ext,
        '/cas/' || substr(content_hash, 1, 2) || '/' || substr(content_hash, 3, 2) || '/'
            || content_hash || ext as dest
    from man where modality <> 'text')"""

SOURCED = f"""{MAN},
sourced as (
    select id, modality, source from man
    union all select printf('msrvtt_%08d', p_partkey), 'video', '{con.VIDEO_SOURCE}' from part
        where p_size < 40 and {_norm('p_name')} <> ''
    union all select doc_id::varchar, 'text', source from documents),
lic as (select *, {LICENSE} as license from sourced)"""

EXTENDED = rf"""a_raw as (
    select row_number() over (order by conv_id, turn) - 1 as idx, text from conversations),
allrows as (
    select 't' || doc_id as id, doc_id as idx, 'text' as modality, text, null::double as dur
    from documents
    union all select 'a' || idx, idx, 'audio', text, length(text) / 100 from a_raw),
ranked as (
    select *, row_number() over (partition by modality, sha256(text) order by idx) as rk,
        length(regexp_replace(text, '\s+', '', 'g')) as vis from allrows),
ext as (
    select id, modality, concat_ws('|',
        case when rk > 1 then 'exact_duplicate' end,
        case when length(text) > 0 and 1 - vis / length(text) > 0.16 then 'extreme_whitespace' end,
        case when modality = 'audio' and (dur < 0.5 or dur > 20) then 'duration_out_of_range' end,
        case when modality = 'audio' and vis = 0 then 'no_transcript' end,
        case when modality <> 'audio' and vis = 0 then 'empty_text' end) as quality_reason
    from ranked),
exts as (select *, {STATUS} as quality_status from ext)"""

FITTING = "greatest(1, ceil(p_size / 8.0)::int)"
_KEYS = "dict keys=[''bytes'', ''path'', ''path_exists'']"
JUDGED = f"""judged as (
    select p_partkey as idx, case when p_size < 40 then 'accept' else 'unusable payload' end as outcome,
        case when p_size < 20 then 'dict.bytes'
             when p_size < 40 then 'dict.path:/in/' || p_partkey || '.mp4'
             else '{_KEYS}' end as shape,
        case when p_size < 40 then {FITTING} else 0 end as clips
    from part where {_norm('p_name')} <> ''
    union all
    select p_partkey, 'no caption', case when p_size < 20 then 'dict.bytes'
             when p_size < 40 then 'dict.path:/in/' || p_partkey || '.mp4' else '{_KEYS}' end, 0
    from part where {_norm('p_name')} = '')"""

SQL: dict[str, str] = {}


def _q(name: str, body: str, ctes: str = "", recursive: bool = False) -> None:
    head = f"with {'recursive ' if recursive else ''}{ctes} " if ctes else ""
    SQL[name] = head + body


# -- sources ---------------------------------------------------------------

_q("manifest_text", f"select {_FLAT}, '' as url, token_count, idx, sub_idx from m_text", M_TEXT)
_q(
    "manifest_image",
    f"""select {_FLAT}, idx as cocoid, filename, 'train' as split,
        to_json(caps)::varchar as all_captions, idx, sub_idx from m_image""",
    M_IMAGE,
)
_q(
    "manifest_video",
    f"""select id, '{con.VIDEO_SOURCE}' as source, 'video' as modality,
        case when p_size < 20 then sha256(p_name) else sha256(id || caption) end as content_hash,
        '{VIDEOS}/' || id || '.mp4' as content, caption, n as n_keyframes, p_type as category,
        to_json(list_transform(range(1, n + 1),
            lambda i: '{FRAMES}/' || id || printf('/frame_%03d.jpg', i)))::varchar as keyframe_paths,
        idx, 0 as sub_idx
    from (select *, p_partkey as idx, {_norm('p_name')} as caption,
              printf('msrvtt_%08d', p_partkey) as id,
              ceil(floor(p_size * 24.0) / 4)::int as n from part)
    where caption <> '' and p_size < 40 and n > 0""",
)
_q(
    "manifest_audio",
    f"""select {_FLAT}, 16000 as sampling_rate, conv_id::varchar as speaker_id,
        turn::varchar as chapter_id, idx, sub_idx from m_audio""",
    M_AUDIO,
)
_q(
    "clip_plan",
    f"""select {_FLAT}, n_keyframes, dur as source_duration_seconds,
        sub_idx * 8.0::double as clip_start_seconds,
        least(8.0, dur - sub_idx * 8.0)::double as clip_duration_seconds,
        p_type as content_parent_category, p_brand as youtube_title, '' as youtube_channel, idx, sub_idx
    from m_video""",
    M_CLIP,
)
_q(
    "clip_plan_bounded",
    """select id, sub_idx, n_keyframes, sub_idx * 8.0::double as clip_start_seconds,
        8.0::double as clip_duration_seconds
    from m_video where sub_idx < greatest(1, least(2, floor(dur / 8.0)::int))""",
    M_CLIP,
)
_q(
    "segment_plan",
    """select idx, piece_idx::int as piece_idx, piece_idx * 10.0::double as piece_start,
        least(10.0, dur - piece_idx * 10.0)::double as piece_seconds
    from (select p_partkey as idx, p_size::double as dur,
              unnest(range(greatest(1, ceil(p_size / 10.0)::int))) as piece_idx from part)""",
)
_q(
    "frame_plan",
    """select idx, (frame_no // 24)::int as frame_idx, frame_no::int as frame_no
    from (select p_partkey as idx, unnest(range(0, p_size * 24, 24)) as frame_no from part)""",
)
_q(
    "bounded_scan",
    "select id, content_hash, idx from m_text where idx < 2000 order by idx limit 100",
    M_TEXT,
)
_q(
    "bounded_scan_clips",
    "select id, content_hash, idx, sub_idx from m_video where idx < 120 order by idx, sub_idx limit 75",
    M_CLIP,
)
_q(
    "sample_text",
    f"""select idx::varchar as id, content as text, '' as url, token_count,
        '{TEXT_SAMPLE_SOURCE}' as source
    from (select * from t_raw order by idx limit 500) where {_words('content')} >= 30""",
    M_TEXT,
)
_q(
    "sample_images",
    f"""select image_id, '{IMAGES}/' || image_id || '.jpg' as image_path, caption,
        '{IMAGE_SAMPLE_SOURCE}' as source, 'train' as split
    from (select printf('coco_dog_%06d', idx) as image_id, {_norm("coalesce(caps[1], '')")} as caption
          from i_raw order by idx limit 100) where caption <> ''""",
    M_IMAGE,
)
_q(
    "source_probe",
    f"""select case when p_size < 50 then 'accept' else 'no video field' end as outcome,
        count(*) as n_rows,
        sum(case when p_size < 50 then {FITTING} else 0 end)::bigint as n_clips
    from part group by 1""",
)
_q("payload_resolve", "select idx, outcome, shape, clips from judged", JUDGED)
_q(
    "payload_resolve_audio",
    """select row_number() over (order by conv_id, turn) - 1 as idx,
        case when role <> 'system' then 'bytes' end as payload_kind from conversations""",
)
_q(
    "source_schema",
    """select unnest(['sentences_raw', 'cocoid', 'image', 'filename', 'split']) as field,
        unnest(['list len=2', 'bigint', 'binary', 'string', 'null']) as shape
    from (select * from pages order by page_id limit 1)""",
)
_q(
    "asset_scan",
    """select folder, strlen(body)::bigint as length, sha256(body) as content_hash,
        '/cas/' || substr(sha256(body), 1, 2) || '/' || substr(sha256(body), 3, 2) || '/'
            || sha256(body) || '.txt' as dest
    from (select (page_id % 64)::varchar as folder,
              string_agg(coalesce(html, '') || chr(10), '' order by page_id) as body
          from pages group by 1)""",
)
_q(
    "source_presets",
    "select * from counts union all select 'finevideo', 'no caption', count(*), 0 from part",
    f"""{JUDGED}, names as (select unnest({[n for n in PRESETS if n != 'finevideo']}) as preset),
    counts as (
        select preset, outcome, count(*) as n_rows, sum(clips)::bigint as n_clips
        from judged, names group by 1, 2)""",
)

# -- quality ---------------------------------------------------------------

DOC_GATE = f"""doc_r as (
    select doc_id, text, {_text_reason('text')} as quality_reason from documents),
doc_g as (select doc_id, quality_reason, {STATUS} as quality_status from doc_r)"""

_q("quality_text", "select doc_id, quality_status, quality_reason from doc_g", DOC_GATE)
for _m in ("image", "video"):
    _q(
        f"quality_{_m}",
        f"select id, quality_status, quality_reason from gated where modality = '{_m}'",
        GATED,
    )
_q(
    "quality_audio",
    f"select vec_id, {STATUS} as quality_status, quality_reason from r",
    """p as (
        select vec_id, list_max(list_transform(embedding, lambda x: abs(x::double * label / 100))) as peak,
            64 / (40 + 20 * label) as seconds from embeddings),
    r as (
        select vec_id, concat_ws('|', case when peak < 0.01 then 'silent_audio' end,
            case when seconds < 0.5 then 'too_short' end) as quality_reason from p)""",
)
_q("quality_gate", "select id, modality, quality_status, quality_reason from gated", GATED)
_q("quality_passed", "select id, modality from gated where quality_status = 'pass'", GATED)
_REPORT = """count(*) as total, count(*) filter (quality_status = 'pass') as passed,
    count(*) filter (quality_status = 'fail') as failed,
    round(count(*) filter (quality_status = 'pass') / count(*), 3) as pass_rate"""
_q("quality_report", f"select modality, {_REPORT} from gated group by modality", GATED)
_q("quality_report_texts", f"select {_REPORT} from doc_g", DOC_GATE)
_q(
    "drop_reasons",
    """select modality, reason, count(*) as n
    from (select modality, unnest(string_split(quality_reason, '|')) as reason
          from gated where quality_status = 'fail') group by 1, 2""",
    GATED,
)
_q("quality_extended", "select id, modality, quality_status, quality_reason from exts", EXTENDED)
_q(
    "quality_extended_report",
    """select modality, count(*) as rows_in,
        count(*) filter (quality_status = 'pass') as rows_kept,
        count(*) filter (quality_status = 'fail') as rows_dropped,
        count(*) filter (contains(quality_reason, 'exact_duplicate')) as duplicate_count,
        0::bigint as missing_asset_count,
        count(*) filter (contains(quality_reason, 'empty_text') or contains(quality_reason, 'no_transcript'))
            as empty_text_or_caption_count,
        count(*) filter (contains(quality_reason, 'duration_out_of_range')) as duration_filtered_count
    from exts group by modality""",
    EXTENDED,
)
_q(
    "safety_gate",
    f"select doc_id, {STATUS} as quality_status, quality_reason from s",
    f"""{DOC_GATE}, tox as (select doc_id, max(toxic) = 1 as unsafe from labels group by doc_id),
    s as (
        select doc_id, concat_ws('|', nullif(quality_reason, ''), case when unsafe then 'unsafe' end)
            as quality_reason
        from doc_g left join tox using (doc_id))""",
)

# -- licences --------------------------------------------------------------

_q("license_tag", "select id, modality, source, license from lic", SOURCED)
_q(
    "license_mix",
    "select license, modality, count(*) as n_items from lic group by 1, 2",
    SOURCED,
)
_q(
    "license_contract",
    """select id, source, case when license = 'unknown' then 'fail' else 'pass' end as quality_status,
        case when license = 'unknown' then 'unlabeled' else '' end as quality_reason from lic""",
    SOURCED,
)

# -- dedup -----------------------------------------------------------------

_FIRST = "qualify row_number() over (partition by content_hash order by idx) = 1"
_q("exact_dedup", f"select id, content_hash from m_text {_FIRST}", M_TEXT)
_q(
    "near_dup_links",
    """select j as pos, min(i) as dup_of from pairs where i in (select pos from kept)
        and j not in (select pos from kept) group by j""",
    STORED,
    True,
)
_q(
    "near_dedup",
    "select pos as vec_id, label from emb where pos in (select pos from kept)",
    STORED,
    True,
)
SQL["near_dedup_rounds"] = SQL["near_dedup"]
_q("near_dedup_incremental", "select pos as vec_id from kept", STORED, True)
_q(
    "curate",
    "select id, content_hash from uniq where idx in (select pos from kept)",
    CURATED,
    True,
)
_q(
    "dedup_report",
    """select (select count(*) from uniq) as rows_after_quality,
        (select count(*) from uniq) - (select count(*) from kept) as near_duplicates_removed,
        (select count(*) from kept) as rows_final""",
    CURATED,
    True,
)

# -- vectors ---------------------------------------------------------------

_q(
    "l2_normalize",
    """select id as vec_id, round(case when n = 0 then 0 else 1 end, 6)::double as length,
        round(sum(case when n = 0 then 0 else y / n end * i), 4) as vec_checksum
    from s join (select id, sqrt(sum(y * y)) as n from s group by id) using (id) group by id, n""",
    """s as (select vec_id as id, unnest(embedding)::double * label as y,
        generate_subscripts(embedding, 1) as i from embeddings)""",
)
_q(
    "mean_pool",
    """select query_id as label, (select count(*) from embeddings where label = query_id) as n_vectors,
        round(sum(m * i), 4) as vec_checksum from cent group by query_id""",
    CENTROIDS,
)
_q(
    "vector_project",
    """select id as vec_id, round(sum(x * w * (j + 1)), 4) as vec_checksum
    from comp join wt using (i) group by id""",
    f"""{CENTROIDS}, wt as (
        select i + 1 as i, j,
            (2.0 * ((i * 7919 + j * 104729 + i * j * 31 + 5 * 1299709) % 65537) / 65537.0 - 1.0)::double
                / sqrt(64) as w
        from range(64) a(i), range(32) b(j))""",
)
_q(
    "embed_batches",
    f"""select id, {TEXT_DIM} as dim, coalesce(vec_checksum, 0) as vec_checksum
    from m_text left join ({_sum_check('v_text')}) using (id)""",
    f"{M_TEXT}, {V_TEXT}",
)
_q("embed_frames", _sum_check("v_video"), f"{M_CLIP}, {V_VIDEO}")
_q(
    "embed_images",
    f"""select id, coalesce(f.vec_checksum, 0) as image_checksum, c.vec_checksum as caption_checksum
    from m_image left join ({_sum_check('v_file')}) f using (id)
    left join ({_sum_check('v_image')}) c using (id)""",
    f"{M_IMAGE}, {V_IMAGE}, {_vectors(_tokens('m_image', 'filename', CLIP_DIM), 'v_file')}",
)
_q(
    "embed_cache",
    f"""select id, 'text_v001' as model_version, lang = 'en' as cached, vec_checksum
    from m_text join firsts using (content_hash) left join ({_sum_check('v_text')}) using (id)""",
    f"""{M_TEXT}, {V_TEXT}, firsts as (
        select content_hash, lang from m_text join documents on doc_id = idx {_FIRST})""",
)
_q(
    "embed_cache_stored",
    """select unnest([1, 2])::int as run, unnest([n, n]) as n_rows, unnest([0::bigint, n]) as n_cached,
        unnest([0::bigint, 0]) as n_null from (select count(*) as n from m_text)""",
    M_TEXT,
)
_q(
    "embed_cache_misses",
    f"""select id, content_hash, 'text_v001' as model_version from m_text
    where content_hash not in (
        select content_hash from m_text where idx in (select doc_id from labels)) {_FIRST}""",
    M_TEXT,
)
_q(
    "embed_metrics",
    f"""select modality, count(*) as n_rows, count(*) as embedded,
        case when modality in ('text', 'audio') then {TEXT_DIM} else {CLIP_DIM} end as dim
    from man group by modality""",
    MAN,
)
_q(
    "feature_enrich",
    f"""select id, content as image_path, caption, vec_checksum
    from m_image left join ({_sum_check('v_cap')}) using (id)""",
    f"{M_IMAGE}, {_vectors(_tokens('m_image', 'caption', TEXT_DIM), 'v_cap')}",
)

# -- search ----------------------------------------------------------------

_DIST = """dist as materialized (
    select query_id, id, label, round(sum((x - m) * (x - m)), 9) as d,
        round(1 - sum(x * m) / (sqrt(sum(x * x)) * sqrt(sum(m * m))), 9) as c
    from comp join cent using (i) group by 1, 2, 3)"""
_q(
    "vector_search",
    f"""select query_id, rank, id, round(d, 6) as distance
    from (select *, {_top('d', 'query_id')} from dist) where rank <= 5""",
    f"{CENTROIDS}, {_DIST}",
)
_q(
    "vector_search_cosine",
    f"""select query_id, rank, id, round(c, 6) as distance
    from (select *, {_top('c', 'query_id')} from dist) where rank <= 5""",
    f"{CENTROIDS}, {_DIST}",
)
_q(
    "vector_search_blocks",
    """select query_id, rank, id, round(d, 6) as distance from (
        select *, row_number() over (partition by query_id order by round(d, 9), id) as rank from pairs)
    where rank <= 3""",
    """vecs as (select vec_id as id, list_transform(embedding, lambda x: x::double) as v from embeddings),
    pairs as (
        select a.id as query_id, b.id, greatest(list_dot_product(a.v, a.v)
            + list_dot_product(b.v, b.v) - 2 * list_dot_product(a.v, b.v), 0) as d
        from vecs a, vecs b where a.id % 2 = 0)""",
)
_q(
    "search_groups",
    f"""select query_id, label as grp, rank, id, round(d, 6) as distance
    from (select *, {_top('d', 'query_id, label')} from dist) where rank <= 5""",
    f"{CENTROIDS}, {_DIST}",
)
_q(
    "search_all",
    """select query_id, modality, rank, id, round(d, 6) as distance,
        caption, license, quality_status,
        case when modality <> 'text' then '/asset/' || id end as asset_url
    from top join gated using (id, modality) where rank <= 5""",
    f"""{GATED}, {V_ALL}, {PROBES},
    qv as (
        select id as query_id, unnest(['text', 'audio']) as modality, b, val from qt
        union all select id, unnest(['image', 'video']), b, val from qc),
    q2 as (select query_id, modality, sum(val * val) as n2 from qv group by 1, 2),
    r2 as (select id, modality, sum(val * val) as n2 from v_all group by 1, 2),
    dots as (
        select q.query_id, r.id, sum(q.val * r.val) as dot
        from qv q join v_all r on q.b = r.b and q.modality = r.modality group by 1, 2),
    hits as (
        select q2.query_id, q2.modality, r2.id,
            round(greatest(q2.n2 + r2.n2 - 2 * coalesce(dot, 0), 0), 9) as d
        from q2 join r2 using (modality)
        left join dots on dots.query_id = q2.query_id and dots.id = r2.id),
    top as (
        select *, row_number() over (partition by query_id, modality order by d, id) as rank from hits)""",
)
SQL["search_isolation"] = f"""
    select modality, 'ok' as status, count(*) as n_hits, count(*) as listed,
        round(sum(distance), 4) as distances
    from ({SQL["search_all"]}) where modality <> 'image' group by modality
    union all select 'image', 'error', 0, 0, null"""
_q(
    "search_images",
    f"""select query_id, rank, id, round(d, 6) as distance, '/image/' || id as image_url
    from (select *, {_top('d', 'query_id')} from hits) where rank <= 5""",
    f"{M_IMAGE}, {V_IMAGE}, {PROBES}, {_sparse_search('v_image', 'qc')}",
)
_q(
    "retrieval_eval",
    """select version, 'text' as modality, count(*) as query_count,
        round(avg(hit), 6) as hit_rate_at_5, round(avg(overlap), 6) as mean_keyword_overlap_at_5,
        round(avg(d), 6) as mean_distance_at_5, 0::bigint as empty_result_count
    from per_query group by version""",
    f"""{M_TEXT}, {V_TEXT}, {PROBES}, {_sparse_search('v_text', 'qt')},
    terms as (
        select item_id as query_id, list_filter(list_distinct(string_split({_norm('text')}, ' ')),
            lambda w: length(w) >= 8) as terms from benchmark),
    firsts as (select id from m_text {_FIRST}),
    ranked as (
        select 'v001' as version, *, {_top('d', 'query_id')} from hits
        union all
        select 'v002', *, {_top('d', 'query_id')} from hits where id in (select id from firsts)),
    scored as (
        select version, query_id, d, case when len(terms) > 0 then
            len(list_intersect(terms, string_split(content, ' '))) / len(terms) else 0 end as o
        from ranked join terms using (query_id) join m_text using (id) where rank <= 5),
    per_query as (
        select version, query_id, max((o > 0)::int) as hit, avg(o) as overlap, avg(d) as d
        from scored group by 1, 2)""",
)

# -- catalog ---------------------------------------------------------------

_q(
    "catalog_build",
    f"""select id, source, modality, content_hash, quality_status, license, caption,
        content as content_path, true as has_embedding,
        case when modality in ('text', 'audio') then coalesce(vec_checksum, 0) else 0 end as text_checksum,
        case when modality in ('image', 'video') then coalesce(vec_checksum, 0) else 0 end as clip_checksum
    from gated left join ({_sum_check('v_all')}) using (id)""",
    f"{GATED}, {V_ALL}",
)
_VERSIONS = [(1, "replace", "'text'"), (2, "append", "'text', 'image'"), (3, "replace", "'audio'"),
    (4, "roll back", "'text', 'image'")]
_q(
    "catalog_versions",
    " union all ".join(
        f"""select {v} as version, '{action}' as action, modality, count(*) as n_rows
        from gated where modality in ({names}) group by modality"""
        for v, action, names in _VERSIONS
    ),
    GATED,
)
_q(
    "catalog_metadata",
    """select man.id, filename, n_keyframes::varchar as n_keyframes, conv_id::varchar as speaker_id
    from man left join (select id, filename from m_image) using (id)
    left join (select id, conv_id from m_audio) using (id)""",
    MAN,
)
_q(
    "catalog_query",
    """select id, modality, source, quality_status from gated where modality = 'text'
    order by id limit 100""",
    GATED,
)
_q(
    "catalog_query_cross",
    """select id, modality, license from gated
    where modality in ('image', 'video') and quality_status = 'pass' and license = 'cc-by-4.0'""",
    GATED,
)
_q(
    "catalog_lookup",
    "select id, modality, caption from gated where id = 'coco_000000000007'",
    GATED,
)
_q(
    "catalog_assets",
    """select id, modality, content as content_path, '/asset/' || id as asset_url,
        case modality when 'image' then 'image/jpeg' when 'video' then 'video/mp4'
            else 'audio/x-wav' end as media_type
    from gated where modality <> 'text'""",
    GATED,
)
_q(
    "catalog_append",
    f"""select id, modality, content_hash,
        case when {_text_reason('content')} = '' then 'pass' else 'fail' end as quality_status,
        'mit' as license, false as has_embedding from m_text""",
    M_TEXT,
)

# -- versions --------------------------------------------------------------

_q("version_create", "select version, pos, id, modality, content_hash from vi", VERSION)
_q(
    "version_limited",
    """select row_number() over (order by modality, id) - 1 as pos, id, modality
    from (select *, row_number() over (partition by modality order by id) as rn
          from gated where quality_status = 'pass' and modality in ('text', 'audio')) where rn <= 50""",
    GATED,
)
_q(
    "version_inputs",
    """select modality as input, count(*) as n_rows,
        sum(('0x' || substr(sha256(length(content_hash) || ':' || content_hash || length(id) || ':' || id),
            1, 15))::bigint)::hugeint::varchar as fingerprint
    from man group by modality""",
    MAN,
)
_PER = ", ".join(
    f"count(*) filter (modality = '{m}') as n_{m}" for m in ("text", "image", "video", "audio")
)
_q(
    "version_list",
    f"""select 'v001' as version, count(*) as total_items, {_PER} from gated
    union all select 'v002', count(*), {_PER} from gated where quality_status = 'pass'""",
    GATED,
)
_q(
    "version_counts",
    """select modality, count(id) as n_items
    from (select unnest(['text', 'image', 'video', 'audio']) as modality)
    left join (select id, modality from gated
               where quality_status = 'pass' and modality in ('text', 'audio')) using (modality)
    group by modality""",
    GATED,
)
_q(
    "version_compare",
    """select modality, coalesce(n_a, 0) as n_a, coalesce(n_b, 0) as n_b,
        coalesce(n_b, 0) - coalesce(n_a, 0) as delta
    from (select modality, count(*) as n_a from va group by 1)
    full join (select modality, count(*) as n_b from vb group by 1) using (modality)""",
    TWO,
)
_q(
    "version_report",
    """select metric, key, coalesce(a, 0) as a, coalesce(b, 0) as b,
        round(coalesce(b, 0) - coalesce(a, 0), 6) as delta
    from (select * from counts where v = 'a') x
    full join (select metric, key, b from (select metric, key, a as b, v from counts) where v = 'b') y
        using (metric, key)""",
    f"""{TWO},
    held as (
        select 'a' as v, * from gated where modality in ('text', 'image')
        union all select 'b', * from gated where quality_status = 'pass'),
    per as (
        select v, metric, key, count(*)::double as n from (
            select v, unnest(['modality', 'source', 'license']) as metric,
                unnest([modality, source, license]) as key from held)
        group by all),
    whole as (select modality as key, count(*) as n from gated group by 1),
    counts as (
        select v, metric, key, n as a from per
        union all
        select v, 'drop_rate', whole.key, round(1 - coalesce(per.n, 0) / whole.n, 6)
        from (select unnest(['a', 'b']) as v) cross join whole
        left join per using (v, key) where coalesce(per.metric, 'modality') = 'modality')""",
)
_q(
    "version_diff",
    """select id, case when va.content_hash is null then 'added'
        when vb.content_hash is null then 'removed'
        when va.content_hash <> vb.content_hash then 'changed' else 'common' end as change
    from va full join vb using (id)""",
    TWO,
)
_q(
    "version_takedown",
    f"""select 'v002' as version, row_number() over (order by {MOD_ORDER}, id) - 1 as pos, id
    from gated where quality_status = 'pass'
        and source not in ('{con.IMAGE_SOURCE}', '{con.AUDIO_SOURCE}')""",
    GATED,
)
SPLIT = f"""{MAN},
bucketed as (
    select id, modality, ('0x' || substr(sha256(id), 1, 8))::bigint % 10000 as bucket,
        substr(sha256(id), 1, 15) as fine from man),
split as (
    select id, modality, case when bucket < 1000 or row_number() over (
        partition by modality order by fine) = 1 then 'eval' else 'train' end as split
    from bucketed)"""
_q("train_eval_split", "select id, modality, split from split", SPLIT)
_q(
    "split_report",
    "select modality, split, count(*) as n_items from split group by 1, 2",
    SPLIT,
)
_q(
    "epoch_order",
    "select id, row_number() over (order by sha256('7:1:' || id), id) - 1 as epoch_pos from man",
    MAN,
)
_q(
    "epoch_resume",
    """select * from (
        select id, row_number() over (order by sha256('7:2:' || id), id) - 1 as epoch_pos from m_text)
    where epoch_pos >= 100""",
    M_TEXT,
)


def _network_back(source: str) -> str:
    """``x`` of ``source`` (with ``n`` and ``key``) one pass back through the
    network of ``operators.epochs``."""
    sides = f"select *, greatest(ceil(sqrt(n)), 1)::bigint as a from ({source})"
    sides = f"select *, ceil(n::double / a)::bigint as b from ({sides})"
    rows = f"select *, x // b as l, x % b as r from ({sides})"
    for step in reversed(range(6)):
        half, other, side = ("r", "l", "b") if step % 2 else ("l", "r", "a")
        noise = f"('0x' || substr(md5(key || ':{step}:' || {other}), 1, 8))::bigint"
        rows = f"select * replace ((({half} - {noise}) % {side} + {side}) % {side} as {half}) from ({rows})"
    return f"select id, what, l * b + r as x, n, key from ({rows})"


_q(
    "epoch_shards",
    f"""size as (select max(idx) + 1 as n, (max(idx) + 64) // 64 as shards from m_text),
    placed as (
        select id, idx, idx // 64 as shard, n, shards,
            case when idx // 64 = shards - 1 then n - 64 * (shards - 1) else 64 end as held
        from m_text, size),
    asked as (
        select id, 'place' as what, shard as x, shards as n, '7:2' as key from placed
        union all select id, 'inner', idx - 64 * shard, held, '7:2:' || shard from placed
        union all select null, 'last', shards - 1, shards, '7:2' from size),
    walk as ({_network_back("select * from asked")}
        union all {_network_back("select * from walk where x >= n")}),
    ends as (select id, what, x from walk where x < n)
    select * from (
        select p.id, shard as shard_idx,
            a.x * 64 - case when l.x < a.x then 64 * shards - p.n else 0 end + i.x as epoch_pos
        from placed p join ends a on a.id = p.id and a.what = 'place'
        join ends i on i.id = p.id and i.what = 'inner' join ends l on l.what = 'last')
    where epoch_pos >= (select n // 2 from size)""",
    M_TEXT + ",",
    True,
)
_MODEL_ROWS = ", ".join(f"('model', '{m}', '{v}')" for m, v in MODELS.items())
_SECTIONS = " union all ".join(
    f"select '{c}' as section, {c} as name, count(*)::varchar as value from passing group by {c}"
    for c in ("modality", "source", "license", "quality_status")
)
_PINNED = json.dumps(
    {
        "modalities": MODALITIES,
        "sources": None,
        "exclude_sources": None,
        "quality_filter": True,
        "limit_per_modality": None,
        "models": MODELS,
        "transforms": {"clip_seconds": 8.0},
    },
    sort_keys=True,
)
_q(
    "datasheet",
    f"""{_SECTIONS}
    union all select 'transforms', 'config', '{_PINNED}'
    union all select 'version', 'v001', count(*)::varchar from passing
    union all select * from (values {_MODEL_ROWS})""",
    f"{GATED}, passing as (select * from gated where quality_status = 'pass')",
)

# -- shards and assets -----------------------------------------------------

_q(
    "shard_plan",
    """select shard_idx, pos, id, modality, caption, license,
        case when modality <> 'text' and ex then id || ext else '' end as asset,
        case when modality = 'text' then content else '' end as text from members""",
    PLAN,
)
_q(
    "shard_manifest",
    """select printf('shard-%06d.tar', s) as shard, count(members.id) as item_count
    from (select distinct pos // 100 as s from vi) left join members on shard_idx = s group by s""",
    PLAN,
)
_q(
    "shard_scan",
    """select printf('shard-%06d.tar', pos // 500) as shard, count(*) as items,
        sum(('0x' || substr(md5(concat_ws('|', id, modality, caption, license, txt)), 1, 8))::bigint)::bigint
            as checksum,
        sum(strlen(txt))::bigint as text_bytes
    from (select pos, id, g.modality, caption, license,
              case when g.modality = 'text' then content else '' end as txt
          from vi join gated g using (id)) group by pos // 500""",
    VERSION,
)
_q("cas_layout", "select id, content_hash, src, dest from lay", CAS)
_q(
    "cas_missing",
    "select dest, min(id) as id from lay where modality = 'image' group by dest",
    CAS,
)
_q(
    "cas_get",
    """select id, dest in (select dest from lay where modality <> 'image') as stored from lay""",
    CAS,
)
_q(
    "cas_gc",
    """select distinct content_hash, ext from gated where modality in ('video', 'audio')
        and content_hash not in (select content_hash from vi)""",
    VERSION,
)
_q(
    "precompute_plan",
    """select dest as src, replace(dest, '/cas/', '/precomputed/') as dest, 224 as width, 224 as height
    from lay where modality = 'image'""",
    CAS,
)

# -- runs and monitors -----------------------------------------------------

_q(
    "artifact_status",
    """select artifact, n is not null as present, coalesce(n, 0) as n_rows
    from (select unnest(['text_manifest', 'image_manifest', 'video_manifest', 'audio_manifest',
              'text_embedded', 'image_embedded', 'video_embedded', 'audio_embedded']) as artifact)
    left join (
        select 'image_manifest' as artifact, count(*) as n from m_image
        union all select 'image_embedded', count(*) from m_image
        union all select 'audio_manifest', count(*) from m_audio) using (artifact)""",
    f"{M_IMAGE}, {M_AUDIO}",
)
_q(
    "artifact_resume",
    """select attempt, stage, modality, case when attempt = 1 then 'ok' else 'skipped' end as status,
        case when stage = 'connectors' and attempt = 1 then ''
             when stage = 'connectors' then 'manifest already exists'
             when attempt = 1 then 'no output yet' else 'preprocessed output already exists' end as reason,
        n as n_rows
    from (select unnest([1, 2]) as attempt),
        (select unnest(['connectors', 'preprocessing']) as stage),
        (select 'image' as modality, count(*) as n from m_image
         union all select 'audio', count(*) from m_audio)""",
    f"{M_IMAGE}, {M_AUDIO}",
)
_q(
    "job_status",
    """select job_key, case when last = 'failed' and failures > 1 then 'dead_letter' else last end as state,
        attempts, failures
    from (select job_key, arg_max(state, (ts, event_id)) as last, count(*) as attempts,
              count(*) filter (state = 'failed') as failures from att group by job_key)""",
    """att as (
        select sha256(user_id || '|text_v001|k' || json_extract_string(props, '$.k')) as job_key, ts, event_id,
            case event_type when 'signup' then 'pending' when 'view' then 'running'
                when 'click' then 'running' when 'purchase' then 'succeeded'
                when 'error' then 'failed' end as state
        from events)""",
)
_q(
    "drift_monitor",
    """select metric, key, count(*) as n, round(count(*) / any_value(total), 6) as share
    from facts join (select metric, count(*) as total from facts group by 1) using (metric)
    group by metric, key""",
    f"""{GATED}, {V_ALL},
    lens as (select id, sqrt(sum(val * val)) as n from v_all group by id),
    facts as (
        select 'modality' as metric, modality as key from gated
        union all select 'source', source from gated
        union all select 'license', license from gated
        union all select 'quality_status', quality_status from gated
        union all select 'norm', printf('%.1f', floor(round(n, 6) * 10) / 10) from lens)""",
)
_q(
    "copy_rate",
    """select modality, count(*) as n_rows, count(distinct content_hash) as n_distinct,
        round((count(*) - count(distinct content_hash)) / count(*), 6) as copy_rate
    from man group by modality""",
    MAN,
)
_q(
    "freshness",
    """select strftime(ts, '%Y-%m-%d') as day, event_type, count(*) as n_rows,
        strftime(max(ts), '%Y-%m-%d %H:%M:%S') as newest from events group by 1, 2""",
)
_q(
    "stream_exact_dedup",
    "select content_hash, min(idx) as first_idx from m_text group by content_hash",
    M_TEXT,
)
_q(
    "position_rank",
    "select conv_id, turn, row_number() over (order by conv_id, turn) - 1 as pos from conversations",
)
