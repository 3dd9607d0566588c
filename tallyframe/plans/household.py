"""The household questionnaire as a ready scope: which answers enter its analysis table, and how.

Everything here is declaration; flatten_scoped, curated_effects and curated_group_tests do the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import answers as A
from tallyframe.functions import recode as R
from tallyframe.operators.flatten import Scope
from tallyframe.operators.reliability import index_value

# Question ids, codes and pairs of the household questionnaire.
SINGLE = (
    "Q4", "Q6", "Q8", "Q10", "Q12", "Q13", "Q16a", "Q20", "Q21a",
    "Q23", "Q24", "Q25", "Q26", "Q27a", "Q29a", "Q30",
)
MULTI = {
    "Q7": ["trong_trot", "chan_nuoi", "cay_duoc_lieu", "lam_nghiep", "phi_nong_nghiep"],
    "Q11": ["hoi_phu_nu", "doan_thanh_nien", "hoi_nong_dan", "khong_hoi_vien"],
    "Q18": [
        "goi_nhan_tin", "doc_tin_tuc", "giai_tri", "tim_kiem_thong_tin",
        "giao_dich_ban_hang", "lam_viec_hoc_online", "mang_xa_hoi", "khac",
    ],
    "Q19": ["quang_ba", "quan_ly_sx_tc", "ban_hang_online", "khong"],
    "Q21b": ["ky_thuat", "khac"],
    "Q22a": ["ngan_hang_thuong_mai", "ngan_hang_chinh_sach", "hoi_doan_the", "khac", "chua"],
    "Q22b": ["khong_co_nhu_cau", "thu_tuc_phuc_tap", "khong_tai_san_the_chap", "khac"],
    "Q28": [
        "thieu_nguon_luc", "thieu_kien_thuc", "ganh_nang_viec_nha", "khong_thi_truong",
        "tap_quan_dinh_kien", "khac", "khong_kho_khan",
    ],
    "Q29b": ["them_thu_nhap", "nang_cao_kien_thuc", "tham_gia_cong_dong"],
    "Q33": ["ban_chu_nhiem_htx", "nhom_san_xuat", "quan_ly_rung", "khong"],
}
MATRIX = {
    "Q14": [
        "lam_dat", "trong", "cham_soc_cay", "thuoc_bvtv", "thu_hoach", "so_che",
        "lien_he_tieu_thu", "khac_san_xuat", "noi_tro", "giat_giu", "dua_don_con",
        "dam_cuoi_gio", "cham_soc_con", "gia_suc_nho", "gia_suc_lon",
        "quan_ly_chi_tieu", "day_do_con", "bao_duong_xe",
    ],
    "Q32": [
        "chon_cay_trong", "mua_vat_tu", "chon_ban", "vay_von", "gia_ban",
        "su_dung_thu_nhap", "su_dung_dat", "khac",
    ],
}
GRID = {"Q17": (["dien_thoai", "may_tinh", "may_tinh_bang"], ["chong", "vo"], "khong_ai_co")}
LABOUR_POSITIVE = ("vo", "ca_hai")
DECISION_POSITIVE = ("vo", "cung_quyet_dinh")
VALUE_CHAIN_ROWS = (
    "lam_dat", "trong", "cham_soc_cay", "thuoc_bvtv", "thu_hoach", "so_che", "lien_he_tieu_thu", "quan_ly_chi_tieu",
)
CHAIN_NODES = ("san_xuat", "thu_hai", "che_bien", "thuong_mai", "tieu_thu")
HIGH_VALUE_NODES = ("thuong_mai", "tieu_thu")
LEADERSHIP = ("Q33_ban_chu_nhiem_htx", "Q33_nhom_san_xuat", "Q33_quan_ly_rung")
STRUCTURAL_COLUMNS = ("province", "commune", "Q4")
BASE_QUESTIONS = {
    "age_bracket": "Q2", "education_grade_bracket": "Q5", "marriage_age_bracket": "Q6", "experience_years_bracket": "Q9",
    "province": "META", "commune": "META",
}
EFFECTS = (
    ("experience and income", "Q9_derived_years_exp", "Q8_ordinal", "slope"),
    ("experience and income", "Q9_derived_years_exp", "Q30", "eta_squared"),
    ("experience and income", "Q9_derived_years_exp", "Q13", "eta_squared"),
    ("schooling and knowledge", "education_grade_bracket", "Q28_thieu_kien_thuc", "eta_squared"),
    ("schooling and knowledge", "education_grade_bracket", "Q29b_nang_cao_kien_thuc", "eta_squared"),
    ("schooling and knowledge", "education_grade_bracket", "Q18_tim_kiem_thong_tin", "eta_squared"),
    ("ethnicity, age, marriage", "Q4", "Q9_derived_years_exp", "eta_squared"),
    ("resources and participation", "Q11_la_hoi_vien", "Q21a_da_tham_gia", "odds_ratio"),
    ("resources and participation", "Q11_la_hoi_vien", "Q33_co_vai_tro_lanh_dao", "odds_ratio"),
    ("resources and participation", "Q25_co_xe_may_rieng", "Q21a_da_tham_gia", "odds_ratio"),
    ("resources and participation", "Q26_phai_xin_phep", "Q21a_da_tham_gia", "odds_ratio"),
    ("resources and participation", "Q22a_da_vay_von", "Q8_ordinal", "eta_squared"),
    ("resources and participation", "Q23", "Q8_ordinal", "eta_squared"),
    ("resources and participation", "Q19_co_ung_dung_cong_nghe", "Q21a_da_tham_gia", "odds_ratio"),
    ("barriers and outcome", "Q28_thieu_kien_thuc", "Q8_ordinal", "eta_squared"),
    ("barriers and outcome", "Q16a_co_thay_doi", "Q33_co_vai_tro_lanh_dao", "odds_ratio"),
    ("barriers and outcome", "Q29a", "Q9_derived_years_exp", "eta_squared"),
)
GROUP_TESTS = (
    ("age at marriage by land title", "Q6_tuoi_ket_hon", "Q27a_dung_ten_dat", "mann_whitney"),
    ("income share by ethnicity", "Q8_ordinal", "Q4", "kruskal_wallis"),
)


def scope() -> Scope:
    def text(answers: Column, *path: str) -> Column:
        return A.path_lookup(answers, [*path, "value"], "string")

    def ticked(answers: Column, name: str) -> Column:
        return A.path_lookup(answers, ["Q5", "components", name, "value"], "boolean")

    def ethnicity(answers: Column) -> Column:
        code = A.sorted_combo(A.path_lookup(answers, ["Q4"]))
        return R.spelling_normalise(R.other_text_override(code, A.path_lookup(answers, ["Q4", "other_text"], "string")))

    married = ("Q6", "subfield", "Q6_tuoi_ket_hon")
    years = ("Q9", "derived_subfield", "Q9_derived_years_exp")
    recodes = {
        "Q2_tuoi": lambda a: R.age_from_year(text(a, "Q2")),
        "age_bracket": lambda a: R.age_bracket(R.age_from_year(text(a, "Q2"))),
        "Q4": ethnicity,
        "Q5_khong_di_hoc": lambda a: ticked(a, "Q5_khong_di_hoc"),
        "Q5_khong_tieng_pho_thong": lambda a: ticked(a, "Q5_khong_tieng_pho_thong"),
        "Q5_trung_cap_dh": lambda a: ticked(a, "Q5_trung_cap_dh"),
        "education_grade_bracket": lambda a: R.education_bracket(
            text(a, "Q5", "components", "Q5_lop_cao_nhat"), ticked(a, "Q5_khong_di_hoc"), ticked(a, "Q5_trung_cap_dh")
        ),
        "Q6_tuoi_ket_hon": lambda a: R.safe_float(text(a, *married)),
        "marriage_age_bracket": lambda a: R.marriage_age_bracket(text(a, *married)),
        "Q9_derived_years_exp": lambda a: R.safe_float(text(a, *years)),
        "experience_years_bracket": lambda a: R.experience_bracket(text(a, *years)),
    }
    return Scope(single=SINGLE, multi=MULTI, matrix=MATRIX, grid=GRID, recodes=recodes)


def helper_columns() -> dict[str, Column]:
    """Columns the curated pairs and indicators need, for derived_columns."""
    def not_ticked(name: str) -> Column:
        return R.mapped(F.col(name).cast("int"), {0: True, 1: False})

    helpers = {
        "Q8_ordinal": R.ordinal_map("Q8"),
        "Q21a_da_tham_gia": F.coalesce(F.col("Q21a").isin("1_3_lan", "tren_3_lan"), F.lit(False)),
        "Q11_la_hoi_vien": not_ticked("Q11_khong_hoi_vien"),
        "Q33_co_vai_tro_lanh_dao": not_ticked("Q33_khong"),
        "Q19_co_ung_dung_cong_nghe": not_ticked("Q19_khong"),
        "Q22a_da_vay_von": not_ticked("Q22a_chua"),
        "Q27a_dung_ten_dat": F.coalesce(F.col("Q27a").isin(*LABOUR_POSITIVE), F.lit(False)),
        "Q25_co_xe_may_rieng": R.yes_no_bool("Q25"),
        "Q26_phai_xin_phep": R.yes_no_bool("Q26"),
        "Q16a_co_thay_doi": R.yes_no_bool("Q16a"),
        "Q30_nhom_khau_cao_gia": R.combo_has("Q30", HIGH_VALUE_NODES),
        "leadership_role": R.any_of_indicators(*LEADERSHIP),
    }
    return helpers | {f"Q30_is_{node}": R.combo_has("Q30", [node]) for node in CHAIN_NODES}


def segment_columns() -> dict[str, Column]:
    """Autonomy features for segments: seven indicators and the two indices."""
    owned = [F.coalesce(F.col(f"Q17_{device}_vo").cast("double"), F.lit(0.0)) for device in GRID["Q17"][0]]
    known = [F.col(f"Q17_{device}_vo").isNotNull().cast("int") for device in GRID["Q17"][0]]

    def rows(qid: str) -> list[str]:
        return [f"{qid}_{row}" for row in MATRIX[qid]]

    def flag(column: Column) -> Column:
        return column.cast("double")

    helpers = helper_columns()
    n_known = known[0] + known[1] + known[2]
    return {
        "owns_devices": F.when(n_known > 0, (owned[0] + owned[1] + owned[2]) / n_known),
        "rides": flag(R.yes_no_bool("Q24")), "owns_motorbike": flag(helpers["Q25_co_xe_may_rieng"]), "member": flag(helpers["Q11_la_hoi_vien"]),
        "trained": flag(helpers["Q21a_da_tham_gia"]), "borrowed": flag(helpers["Q22a_da_vay_von"]), "land_title": flag(helpers["Q27a_dung_ten_dat"]),
        "labour_index": index_value(rows("Q14"), LABOUR_POSITIVE), "decision_index": index_value(rows("Q32"), DECISION_POSITIVE),
    }


def clean_manifest_regions(manifest: DataFrame) -> DataFrame:
    """Commune slugs without the form count that folders carry."""
    return manifest.withColumns({"commune_raw": F.col("commune"), "commune": R.strip_suffix("commune")})
