"""Schemas of the corpus and of the nested shard files."""

from __future__ import annotations

META = "struct<id:string,dump:string,url:string,file_path:string>"
ENTITIES = "map<string,string>"

CORPUS = "id string, text string, dump string, url string, file_path string"

# One tokenized shard.
TOKENIZED = (
    "tokenized_inputs array<struct<batch:struct<input_ids:array<array<int>>,attention_mask:array<array<int>>>,"
    f"placeholder_entity_maps:array<{ENTITIES}>>>, "
    f"ids array<array<string>>, row bigint, shard bigint, meta_data array<{META}>"
)

# One translated shard before decoding.
OUTPUTS = (
    f"outputs array<array<array<int>>>, placeholder_entity_maps array<array<{ENTITIES}>>, "
    f"ids array<array<string>>, meta_data array<{META}>, row bigint, shard bigint"
)

# One merged shard.
MERGED = f"text array<array<string>>, uuid array<string>, row bigint, shard bigint, meta_data array<{META}>"

# One published row.
PUBLISHED = f"text array<string>, uuid string, meta_data {META}"

PROGRESS = "batch_id bigint, file_no bigint, row bigint, sentences bigint, shard bigint"
