"""Schemas of the domain tables, as DDL; nothing is inferred."""

VOLUMES = (
    "identifier string, eb_code string, edition_label string, edition_num int, edition_year int, is_supplement boolean, supplement_to string, volume_num int, "
    "volume_label string, alpha_range string, date_issued string, n_images bigint, n_pages_mets bigint, pages_match boolean, rights string, title string, volume_dir string"
)
PAGES = "identifier string, idx int, image string, markdown string, raw string, token_count bigint, error boolean, error_kind string, msg string"
PAGE_LINE = "image string, markdown string, raw string, token_count bigint, error boolean, error_kind string, msg string"
ANSWERS = f"identifier string, {PAGE_LINE}"
STATES = "identifier string, n_pages bigint, n_ocr_ok bigint, failed_pages array<string>, total_tokens bigint, complete boolean, elapsed_s double, closed_at double"
BLOCKS = (
    "array<struct<pos:int,label:string,bbox:string,text:string,html:string,"
    "paras:array<struct<text:string,html:string,bold:string,bold_tail:string,lead:string>>,heads:array<struct<level:int,text:string>>>>"
)
PROVENANCE = (
    "struct<image_files:array<string>,headword_bbox:array<int>,headword_image:string,raw_headword:string,raw_base_headword:string,"
    "headword_correction:struct<`from`:string,`to`:string,n_editions:int,edit_distance:int,source:string>,"
    "absorbed_split:struct<recovered:array<string>,original_char_count:int,source:string>,relabeled_from:string,split_from:string,source:string,"
    "raw_printed_page_end:int,absorbed_split_fix:string,recovered_by:string>"
)
ARTICLES = (
    "headword string, base_headword string, qualifier string, type string, detected_by string, is_cross_reference boolean, volume_num int, eb_code string, identifier string, "
    "alpha_range string, printed_page_start int, printed_page_end int, image_page_start int, image_page_end int, body_text string, body_html string, "
    "cross_refs array<string>, char_count int, outline array<struct<level:int,label:string,printed_page:int,image_page:int>>, "
    f"provenance {PROVENANCE}"
)
