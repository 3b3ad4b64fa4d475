"""Rules on hand-written cases."""

from conftest import rows_of

from sparley.functions import expr, rules


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(column).collect()]


def test_classify(spark):
    cases = {
        ("소위원장 홍길동", None): ("chair", "홍길동", "소위원장 홍길동"),
        ("홍길동위원", None): ("legislator", "홍길동", "홍길동위원"),
        ("홍길동", "123"): ("legislator", "홍길동", "홍길동"),
        ("국방부장관후보자 홍길동", None): ("minister_nominee", "홍길동", "국방부"),
        ("국무총리후보자 홍길동", None): ("nominee", "홍길동", "국무총리후보자 홍길동"),
        ("국무총리 홍길동", "0"): ("prime_minister", "홍길동", "국무총리 홍길동"),
        ("증인 이증언", ""): ("witness", "이증언", ""),
        ("감사원장 유감사", None): ("audit_official", "유감사", "감사원장 유감사"),
        ("", "5"): ("unknown", "", ""),
        (None, None): ("unknown", "", ""),
        ("홍길동", None): ("other", "홍길동", "홍길동"),
    }
    got = values(spark, rules.classify_speaker("s", "m"), list(cases), "s string, m string")
    assert [tuple(x) for x in got] == list(cases.values())


def test_titles(spark):
    got = values(spark, rules.extract_title("n"), [("직무대행 홍길동",), ("대리",), ("홍길동 의원",), ("의원",), (None,)], "n string")
    assert [tuple(x) for x in got] == [("홍길동", "직무대행"), ("대리", None), ("홍길동", None), ("의원", None), (None, None)]


def test_ministries(spark):
    cases = {"국토교통부장관 홍길동": "국토교통부", "여성부": "여성가족부", "법부무": "법무부", "X공사": None, "": None, None: None, "보 해양수산부": "해양수산부", "리본부": None, "국가보훈처장 박승춘": "국가보훈처"}
    assert values(spark, rules.normalize_ministry("r"), [(x,) for x in cases], "r string") == list(cases.values())


def test_dates(spark):
    cases = {"2001년9월4일(화)": "2001-09-04", "2001년 9月 14日(金)": "2001년 9月 14日(金)", "2001年 9月 14日(金)": "2001-09-14", "2001-09-04": "2001-09-04", "20010904": "2001-09-04", "bad": "bad", None: None}
    assert values(spark, expr.date_text("d"), [(x,) for x in cases], "d string") == list(cases.values())


def test_names(spark):
    rows = [("안전센터 서헌식", None, None), ("안전센터 서헌식", "소방청", None), ("홍길동", "x", None), ("환경부 이수진(비)", "", None), ("안전센터 서헌식", None, "7")]
    got = values(spark, rules.split_name("n", "a", "m"), rows, "n string, a string, m string")
    assert [tuple(x) for x in got] == [("서헌식", "안전센터"), ("서헌식", "안전센터 소방청"), ("홍길동", "x"), ("이수진(비)", "환경부"), ("안전센터 서헌식", None)]


def test_texts_and_keys(spark):
    assert values(spark, expr.normalize_text("t"), [("a  b   c ",), ("　x　",), (None,)], "t string") == ["a b c", "x", None]
    assert values(spark, expr.padded("t"), [("12345",), ("1234567",)], "t string") == ["012345", "1234567"]
    assert values(spark, expr.is_blank("t"), [("",), (" ",), ("nan",), (None,), ("x",)], "t string") == [True, True, True, True, False]
    assert values(spark, expr.flag("t"), [("Y",), ("N",), (None,)], "t string") == [True, False, False]


def test_titles_that_are_none_move(spark):
    got = values(spark, rules.move_bad_title("t", "a"), [("대리", "x"), ("차관", "x"), ("차관", None), (None, "x")], "t string, a string")
    assert [tuple(x) for x in got] == [("대리", "x"), (None, "차관 x"), (None, "차관"), (None, "x")]


def test_missing_names_come_from_labels(spark):
    got = values(spark, rules.recover_name("n", "s"), [("", "김부겸 위원장"), ("nan", "여성가족부 장관 x"), ("a", "김부겸 위원장")], "n string, s string")
    assert got == ["김부겸", "nan", "a"]


def test_shared_ids_are_told_apart(spark):
    rows = [(1, "7407", "E6S73230", 17, "남"), (2, "7407", "0W194007", 20, "여"), (3, "7407", None, 20, "남"), (4, "7407", "0W194007", 20, "여"), (5, "9", None, 20, None)]
    df = rules.disambiguate(spark.createDataFrame(rows, "id int, member_id string, naas_cd string, term int, gender string"))
    assert rows_of(df.select("id", "member_uid")) == [(1, "7407_A"), (2, "7407_B"), (3, "7407_B"), (4, "7407_B"), (5, "9")]
    assert rows_of(rules.homogenize(df, ["gender"]).select("id", "gender")) == sorted([("남", 1), ("여", 2), ("여", 3), ("여", 4), (None, 5)], key=repr)


def test_reclassification_keeps_other_roles(spark):
    got = values(spark, rules.reclassify_other("r", "s"), [("other", "육군참모총장 남육군"), ("witness", "육군참모총장"), ("other", "무엇"), ("other", None), (None, "교수")], "r string, s string")
    assert got == ["military", "witness", "other", "other", None]


def test_all_roles_of_the_documented_cascade(spark):
    cases = {"방송통신위원장 이위원": "independent_official", "소위원장 홍길동": "chair", "국방부장관직무대행 홍길동": "minister_acting", "육군참모총장 남육군": "military", "서울경찰서장 강경찰": "police", "한국은행장 임은행": "public_corp_head", "금융감독원 부원장보 김": "financial_regulator", "한국교육연구원장 이": "research_head", "국립박물관장 박": "cultural_institution_head", "농협조합장 최": "cooperative_head", "기획조정실장 윤": "senior_bureaucrat", "통상정책관 정": "mid_bureaucrat", "서울특별시장 오": "local_gov_head", "주식회사 가나다 이": "private_sector", "정책보좌관 김": "other_official", "누구": "other"}
    got = values(spark, rules.classify_speaker("s", "m", rules.V.SPEAKER_RULES_ALL), [(s, None) for s in cases], "s string, m string")
    assert [g["role"] for g in got] == list(cases.values())


def test_committee_names(spark):
    cases = {"국방위원회": "defense", "행정안전위원회-예결소위": "public_admin", "교육문화체육관광위원회": "education_culture", "모르는위원회": "other", "국토해양위원회": "land_transport"}
    assert values(spark, rules.committee_key("c"), [(c,) for c in cases], "c string") == list(cases.values())
